"""Crowded buckets by signatures first; contaminated long texts without a search per place."""

from __future__ import annotations

import random
import time

import pytest
from conftest import SF001

pytest.importorskip("dailytally.llm")
import brute  # noqa: E402
from test_operators import same  # noqa: E402

from dailytally.llm import decontaminate, minhash  # noqa: E402
from dailytally.llm.common import ship, table  # noqa: E402


@pytest.fixture()
def counts(monkeypatch):
    """The rows of each table that the near-duplicate operator writes."""
    seen, own = {}, minhash.stored

    def stored(df, name):
        out = own(df, name)
        seen[name] = seen.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(minhash, "stored", stored)
    return seen


def test_chains_in_blocks_of_both_kinds(spark, monkeypatch, counts):
    ship(spark)
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 4)
    monkeypatch.setattr(minhash, "SIGNATURE_ROWS", 9)
    words = [f"w{i}" for i in range(400)]
    own = [(i, " ".join(words[4 * i : 4 * i + 60])) for i in range(70)] + [(100 + i, " ".join(words[:40] + [f"x{i}-{j}" for j in range(30)])) for i in range(30)]
    df = spark.createDataFrame(own, "doc_id long, text string").repartition(4)
    same([tuple(r)[:3] for r in minhash.near_duplicates(df, 4).collect()], brute.near(own, 4))


def test_alike_but_unlinked_texts_do_not_travel(spark, monkeypatch, counts):
    """Texts that share two thirds of their words meet in buckets, but no text goes to a block."""
    ship(spark)
    monkeypatch.setattr(minhash, "SIGNATURE_ROWS", 50)
    common = [f"c{i}" for i in range(100)]
    own = [(i, " ".join(common + [f"x{i}-{j}" for j in range(50)])) for i in range(300)]
    df = spark.createDataFrame(own, "doc_id long, text string").repartition(3)
    got = [tuple(r)[:3] for r in minhash.near_duplicates(df, 4).collect()]
    assert got and all(d == c for d, _, c in got)
    assert counts["crowded"] > 300  # they do meet
    assert counts["partnered"] == 0


def test_long_contaminated_text(spark):
    items = [(r.item_id, r.text) for r in table(spark, SF001, "benchmark").collect() if r.text]
    rnd = random.Random(2)
    own = [(1, "\n".join(t for _, t in items)), (2, " ".join(rnd.choice(items)[1] + f" z{i}" for i in range(60))), (3, items[0][1]), (4, "clean words only")]
    docs = spark.createDataFrame(own, "doc_id long, text string")
    items += [(700, "a short item"), (701, "w1")]
    own_items = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.decontaminate(docs, own_items).drop("tk").collect()
    same(got, brute.decontaminate(own, items))
    assert {r.doc_id: r.contaminated for r in got} == {1: True, 2: True, 3: True, 4: False}


def test_time_of_a_contaminated_text_is_near_linear(spark):
    def seconds(n):
        words = " ".join(f"v{i}" for i in range(n))
        docs = spark.createDataFrame([(1, words)], "doc_id long, text string")
        item = spark.createDataFrame([(5, words)], "item_id long, text string")
        t = time.time()
        r = decontaminate.decontaminate(docs, item).first()
        assert (r.n_words, r.n_hit, r.n_items) == (n, n, 1)
        return time.time() - t

    seconds(2000)
    assert seconds(80_000) < 12 * max(seconds(20_000), 1.0)
