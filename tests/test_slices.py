"""Slices of a batch: cut anywhere, only their edges go to the state."""

import random

import pandas as pd

from tests.test_reassembly import columns, one_by_one, stream
from tidewake.streaming import reassembly


def test_slices_make_no_difference():
    rng = random.Random(5)
    for _ in range(20):
        frames = [f for _ in range(3) for f in stream(rng) + [bytes([rng.choice([0, 3, 7]) << 5 | rng.randrange(1, 32)]) + bytes(7) for _ in range(rng.choice([0, 150]))]]
        table, size = columns(frames), rng.choice([5, 20, 90, 400])
        cut = []
        for k in range(0, len(frames), size):
            part = table[table["seq"] // size == k // size].sample(frac=1, random_state=k)
            cut.append(reassembly.within(("d", "can0", 7, k // size), part.assign(device_id="d", src="can0", can_id=7)))
        rows = pd.concat(cut)
        assert list(rows.columns) == reassembly.CUT_NAMES
        whole, edges = rows[rows["whole"].astype(bool)], rows[~rows["whole"].astype(bool)]
        done, _ = reassembly.put_together(edges, {})
        assert sorted([(s, p) for s, p in zip(whole["seq"], whole["payload"])] + [(m[0], m[2]) for m in done]) == one_by_one(frames)
        # However long a slice, its edges are two runs a counter at most.
        assert all((~c["whole"].astype(bool)).sum() <= 3 * 2 * (reassembly.RUN + 1) for c in cut)
