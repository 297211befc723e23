"""Sharding by jump consistent hashing, as column expressions only.

Cases: a null id is key 0; a null text has size 8 and checksum 0; repeated rows are
rows of their own with the same shard and neighbouring slots; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARDS = 24
#: Parts of a shard that are numbered apart, so that no shard is one task's work.
SLOT_PARTS = 256
#: A prime and a factor that mix ids into slot parts.
MIX_PRIME, MIX_FACTOR = 1_000_003, 2_654_435_761

# Multiplier of the generator of jump consistent hashing, as two 32-bit halves.
MULTIPLIER_HIGH = 2862933555777941757 >> 32
MULTIPLIER_LOW = 2862933555777941757 & 0xFFFFFFFF


def _low32(x: Column) -> Column:
    return x.bitwiseAND(F.lit(0xFFFFFFFF))


def _next_key(key: Column) -> Column:
    """``key * multiplier + 1`` modulo 2**64, in 16- and 32-bit limbs, as ANSI arithmetic does not wrap."""
    high, low = F.shiftrightunsigned(key, 32), _low32(key)
    low0, low1 = low.bitwiseAND(F.lit(0xFFFF)), F.shiftrightunsigned(low, 16)
    high0, high1 = high.bitwiseAND(F.lit(0xFFFF)), F.shiftrightunsigned(high, 16)
    m_low, m_high = F.lit(MULTIPLIER_LOW), F.lit(MULTIPLIER_HIGH)
    first = low0 * m_low + F.lit(1)
    second = low1 * m_low + F.shiftrightunsigned(first, 16)
    new_low = F.shiftleft(second.bitwiseAND(F.lit(0xFFFF)), 16).bitwiseOR(first.bitwiseAND(F.lit(0xFFFF)))
    crossed = (
        F.shiftrightunsigned(second, 16)
        + high0 * m_low
        + F.shiftleft((high1 * m_low).bitwiseAND(F.lit(0xFFFF)), 16)
        + _low32(low0 * m_high)
        + F.shiftleft((low1 * m_high).bitwiseAND(F.lit(0xFFFF)), 16)
    )
    return F.shiftleft(_low32(crossed), 32).bitwiseOR(new_low)


def jump_shards(key: Column, shards: int = SHARDS) -> Column:
    """struct(shard, grown_shard): the shard of ``key`` among ``shards`` and among one more.

    Both come from one run of jumps: the last place below ``shards`` and the last one
    at or below it.  A run has at most as many jumps as shards.
    """
    jump = F.lit(float(1 << 31))

    def step(state: Column, _: Column) -> Column:
        ahead = F.floor((state["place"] + 1) * (jump / (F.shiftrightunsigned(state["key"], 33) + 1)))
        return F.when(
            ahead <= shards,
            F.struct(
                _next_key(state["key"]).alias("key"),
                ahead.cast("long").alias("place"),
                F.when(ahead < shards, ahead.cast("long")).otherwise(state["shard"]).alias("shard"),
            ),
        ).otherwise(state)

    start = F.struct(
        _next_key(F.coalesce(key.cast("long"), F.lit(0).cast("long"))).alias("key"),
        F.lit(0).cast("long").alias("place"),
        F.lit(0).cast("long").alias("shard"),
    )
    end = F.aggregate(F.sequence(F.lit(1), F.lit(shards)), start, step)
    return F.struct(
        end["shard"].cast("int").alias("shard"), end["place"].cast("int").alias("grown_shard")
    )


def _slot_part(key: Column, slot_parts: int) -> Column:
    """Multiplicative hash of the key's remainder by a prime; the products fit 64 bits."""
    mixed = F.pmod(F.pmod(key, F.lit(MIX_PRIME)) * F.lit(MIX_FACTOR), F.lit(1 << 32))
    return F.floor(mixed * F.lit(slot_parts) / F.lit(float(1 << 32))).cast("long")


def shard_documents(docs: DataFrame, shards: int = SHARDS, slot_parts: int = SLOT_PARTS) -> DataFrame:
    """One row per document: size, checksum, shard, slot in the shard, and shard after one is added.

    Slots follow (part, id, checksum); the part mixes the bits of the id, so that ids in regular steps fill all parts.  The counts of all parts are a table of
    ``shards * slot_parts`` rows at most, which is small enough to broadcast; each part is numbered alone.
    """
    text = F.col("text")
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(8)).cast("long").alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
    )
    part = _slot_part(F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")), slot_parts)

    def placed(df: DataFrame) -> DataFrame:
        found = df.withColumn("_jump", jump_shards(F.col("doc_id"), shards)).withColumn("_part", part)
        return found.select("*", "_jump.shard", "_jump.grown_shard").drop("_jump")

    counts = placed(docs.select("doc_id")).groupBy("shard", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = _total_before(counts)
    numbered = placed(rows).withColumn(
        "_at", F.expr("row_number() over (partition by shard, _part order by doc_id, text_crc32, size)")
    )
    return numbered.join(F.broadcast(before), ["shard", "_part"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("_before") + F.col("_at") - 1).cast("long").alias("slot"),
        "grown_shard",
    )


def _total_before(counts: DataFrame) -> DataFrame:
    """Rows of the parts before each part of a shard; the window sees ``slot_parts`` rows a shard."""
    running = F.expr("sum(_n) over (partition by shard order by _part)")
    return counts.select("shard", "_part", (running - F.col("_n")).alias("_before"))


def oracle_sql(shards: int = SHARDS, slot_parts: int = SLOT_PARTS) -> str:
    """DuckDB twin: the jumps as a recursive query over wide integers, the checksum bit by bit."""
    return f"""
with recursive jumps(doc_id, k, place, shard, rid) as (
  select doc_id, ((coalesce(doc_id, 0)::hugeint + 18446744073709551616) % 18446744073709551616
      * 2862933555777941757 + 1) % 18446744073709551616, 0::bigint, 0::bigint, rowid_
  from (select doc_id, row_number() over () as rowid_ from documents)
  union all
  select doc_id, (k * 2862933555777941757 + 1) % 18446744073709551616, ahead,
    case when ahead < {shards} then ahead else shard end, rid
  from (select *, floor((place + 1) * (2147483648e0 / ((k // 8589934592) + 1)))::bigint as ahead from jumps)
  where ahead <= {shards}
), ends as (select rid, max(place) as grown, max(shard) as shard from jumps group by rid),
crc_table as (
  select list(c order by n) as t from (
    select n, list_reduce(list_prepend(n::ubigint, [1, 2, 3, 4, 5, 6, 7, 8]::ubigint[]),
      lambda c, _: case when c & 1 = 1 then xor(c >> 1, 3988292384::ubigint) else c >> 1 end) as c
    from range(256) r(n))
), docs as (
  select row_number() over () as rid, doc_id, coalesce(text, '') as text from documents
), sized as (
  select d.rid, doc_id, octet_length(encode(text)) + 8 as size,
    xor(list_reduce(list_prepend(4294967295::ubigint,
        list_transform(range(octet_length(encode(text))),
          lambda i: ('0x' || substr(h, 2 * i::int + 1, 2))::ubigint)),
      lambda c, b: xor(t[(xor(c, b) & 255)::int + 1], c >> 8)), 4294967295::ubigint) as crc
  from (select *, hex(encode(text)) as h from docs) d, crc_table
)
select doc_id, size::bigint as size, crc::bigint as text_crc32, 'key' as law, shard::int as shard,
  row_number() over (partition by shard
    order by floor((((coalesce(doc_id, 0) % {MIX_PRIME} + {MIX_PRIME}) % {MIX_PRIME}) * {MIX_FACTOR} % 4294967296) * {slot_parts} / 4294967296e0),
      doc_id, crc, size) - 1 as slot,
  grown::int as grown_shard
from sized join ends using (rid)
"""
