"""What a Python worker holds between tasks, since Spark keeps it for the whole session."""

from __future__ import annotations

import itertools
import os
import sys

import numpy as np
import pyarrow as pa
import pytest

from rookery.llm.queries import tokenizer_path
from rookery.llm.rows import lean
from rookery.llm.word_ids import WordIds


def _resident_mb() -> float:
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE") / (1 << 20)


@pytest.mark.skipif(sys.platform != "linux", reason="reads /proc")
def test_a_task_gives_back_what_it_has_freed():
    """Small arrays below one that stays: the allocator alone would keep all of their memory."""
    stays = []

    def run(batches):
        for batch in batches:
            work = [np.ones(500) for _ in range(40_000)]
            stays.append(np.ones(500))
            yield batch
            del work

    batch = pa.RecordBatch.from_pydict({"n": [1]})
    before = _resident_mb()
    assert list(lean(run)([batch])) == [batch]
    assert _resident_mb() - before < 40


def test_word_memory_is_bounded():
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = ["".join(w).encode() for w in itertools.islice(itertools.product(letters, repeat=5), 600_000)]
    encoder = WordIds(tokenizer_path())
    for first in range(0, len(words), 10_000):
        encoder.of([b" ".join(words[first : first + 10_000])])
    assert len(encoder.young) + len(encoder.old) <= 420_000
