"""op8's CPU seconds: hashes of 32 bits, and signatures of a block compared eight places at a time."""

from __future__ import annotations

import numpy as np
import pandas as pd

from dailytally.llm import minhash as M


def sets(rng, same, other):
    x = rng.integers(0, 1 << 64, same + 2 * other, np.uint64)
    return np.unique(x[: same + other]), np.unique(np.concatenate([x[:same], x[same + other :]]))


def test_signatures_are_of_32_bits_and_tell_how_far_sets_agree():
    rng, family = np.random.default_rng(3), M._family(M.HASHES)
    assert {f.dtype.itemsize for f in family} == {4}
    for same, other in ((8, 1), (80, 10), (800, 100), (20_000, 2_500)):  # 80 %: at the threshold
        for _ in range(20):
            a, b = (M.signature(s, family) for s in sets(rng, same, other))
            assert abs((a == b).mean() - 0.8) < 0.1
            keys = M.band_keys(np.stack([a, b]))
            assert (keys[0] == keys[1]).any()
            assert M.agreement(a.astype(np.uint8)[None], b.astype(np.uint8)).tolist() == [(a.astype(np.uint8) == b.astype(np.uint8)).sum()]
    a, b = (M.signature(s, family) for s in sets(rng, 100, 900))
    assert (a == b).mean() < 0.15


def test_agreement_of_all_places_and_of_none():
    x = np.arange(M.HASHES, dtype=np.uint64).astype(np.uint8)
    assert M.agreement(np.stack([x, x + np.uint8(1), x]), x).tolist() == [M.HASHES, 0, M.HASHES]


def test_pairs_of_a_part_are_those_of_brute_force():
    rng = np.random.default_rng(5)
    n, base, shared = 60, rng.integers(0, 256, M.HASHES), rng.integers(0, 1 << 62, M.BANDS)
    sig = np.where(rng.random((n, M.HASHES)) < 0.88, base, rng.integers(0, 256, (n, M.HASHES))).astype(np.uint8)
    keys = np.where(rng.random((n, M.BANDS)) < 0.1, shared, rng.integers(0, 1 << 62, (n, M.BANDS)))
    band = rng.choice([4, 9], n)  # two buckets in one part, as if their hashes were the same
    keys[np.arange(n), band] = shared[band]
    for side in (np.full(n, 2), rng.integers(0, 2, n)):
        pdf = pd.DataFrame({"side": side, "key": shared[band], "n": rng.integers(80, 120, n), "component": rng.integers(0, 9, n).astype(str),
                            "keys": list(keys), "sig": [s.tobytes() for s in sig]})
        exp = {}
        for i in range(n):
            for j in range(i + 1, n):
                x, y = pdf.iloc[i], pdf.iloc[j]
                first = next((a for a, b in zip(keys[i], keys[j], strict=True) if a == b), None)
                agree = (sig[i] == sig[j]).mean()
                if (x.key == y.key == first and x.component != y.component and (x.side != y.side or x.side == 2)
                        and 100 * min(x.n, y.n) >= M.PERCENT * max(x.n, y.n) and agree >= M.LIKELY):
                    exp[i, j] = agree
        got = {(min(i, b), max(i, b)): a for i, j, agree in M.likely_in_block(pdf) for b, a in zip(j.tolist(), agree.tolist(), strict=True)}
        assert exp and got == exp
