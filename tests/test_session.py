"""Session helpers."""

import time
from concurrent.futures import ThreadPoolExecutor
from types import SimpleNamespace

from riskframe import session


def test_package_is_sent_once_from_several_threads(monkeypatch):
    """Spark refuses a second file of the same name, and forests of a grid are fitted in threads."""
    sent = []

    def add(path):
        time.sleep(0.05)
        sent.append(path)

    monkeypatch.setattr(session, "_shipped", set())
    spark = SimpleNamespace(sparkContext=SimpleNamespace(applicationId="app-of-this-test", addPyFile=add))
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(session.ship_package, [spark] * 6))
    assert len(sent) == 1
