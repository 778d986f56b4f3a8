"""What a fit has freed goes back to the system."""

import ctypes
import re
from pathlib import Path

import numpy as np
import pytest

from tenderlake.llm import common, toxicity


def held_mb() -> float:
    return sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()))) / 1024


@pytest.mark.skipif(not hasattr(ctypes.CDLL(None), "malloc_trim"), reason="only glibc gives back")
def test_small_arrays_go_back_to_the_system():
    common.give_back()
    before = held_mb()
    arrays = [np.ones(5000) for _ in range(4000)]
    last = arrays[-1]  # at the end of the heap: all below it stays with the C library until it is asked
    assert held_mb() - before > 120
    del arrays
    common.give_back()
    assert held_mb() - before < 40 and last.sum() == 5000


def test_a_fit_gives_back(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(toxicity, "give_back", lambda: calls.append(1), raising=False)
    docs = spark.createDataFrame([(k, "bad word" if k % 2 else "fine text") for k in range(40)], "doc_id long, text string")
    toxicity.fit(docs, docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as toxic"))
    assert calls == [1]
