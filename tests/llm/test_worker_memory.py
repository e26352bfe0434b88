import os

from insight.llm import shared


def _resident_mb() -> float:
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE") / 2**20


def test_a_new_stage_gives_back_what_the_last_one_freed():
    # Texts of a few KB live on the C heap; a few that stay keep the freed ones from its top.
    blobs = [os.urandom(8) * 512 for _ in range(200_000)]
    staying = blobs[::200]
    shared._kept["texts of an earlier stage"] = (10**9, blobs)
    del blobs
    before = _resident_mb()
    shared._forget()
    after = _resident_mb()
    assert "texts of an earlier stage" not in shared._kept
    assert before - after > 400, (before, after)
    assert len(staying) == 1_000
