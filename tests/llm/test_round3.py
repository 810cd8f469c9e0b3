"""Exact top-k search, conversation repair and token alignment against plain versions."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from dailytally.llm import convrepair, crosstoken, queries, topk
from dailytally.llm.common import ship, table

SF = "/root/testdata/sf0.001"
NAMES = ("row", "rank", "place", "ck", "block", "sig", "kind", "code", "n", "pairs", "score", "_rank")


def clash(df):
    """Extra columns under names that the operators use themselves."""
    return df.withColumns({c: F.lit("clash") for c in NAMES if c not in df.columns})


# --- top-k -----------------------------------------------------------------


def plain_top_k(rows, every, k):
    own = []
    for i, (vec_id, x) in enumerate(rows):
        if x is not None and all(v is not None and np.isfinite(v) for v in x):
            own.append((i, vec_id, [int(v) for v in np.floor(1024.0 * np.array(x, np.float64))]))
    out = []
    for i, vec_id, q in own:
        if vec_id is None or vec_id % every:
            continue
        found = []
        for j, other, x in own:
            if j != i:
                s = sum(a * b for a, b in zip(q, x, strict=False))
                found.append((-min(topk.MOST, max(topk.LEAST, s)), other is None, other or 0, other))
        out += [(vec_id, r + 1, f[3], -f[0]) for r, f in enumerate(sorted(found, key=lambda f: f[:3])[:k])]
    return Counter(out)


def vectors(seed, n, sparse):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 12)) * 0.3
    if sparse:
        x[rng.random(x.shape) < 0.85] = 0
    rows = [(i, [float(np.float32(v)) for v in r]) for i, r in enumerate(x)]
    rows += [(n, rows[0][1]), (n + 1, rows[0][1]), (0, rows[0][1])]  # ties, a repeated row
    rows += [(n + 2, None), (n + 3, [1.0, None]), (n + 4, [float("nan")] * 12), (n + 5, [float("inf")]), (None, rows[5][1])]
    return [*rows, (n + 6, []), (n + 7, [0.0] * 12), (n + 8, [0.5] * 3), (5 * n, [-1.0] * 40)]


@pytest.mark.parametrize(("sparse", "block", "shard"), [(False, 1 << 20, 1 << 20), (True, 1 << 20, 500), (True, 60, 100), (False, 60, 300)])
def test_top_k_equals_all_scores(spark, sparse, block, shard):
    ship(spark)
    rows = vectors(7, 400, sparse)
    df = clash(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5))
    got = topk.search_embeddings(df, 40, 10, block, shard).select("query_id", "rank", "vec_id", "score")
    assert Counter(map(tuple, got.collect())) == plain_top_k(rows, 40, 10)


def test_top_k_beyond_doubles_and_few_rows(spark):
    ship(spark)
    rows = [(0, [3e38, 1.0]), (1, [1e10, 2.0]), (2, [-3e38, 0.0]), (3, [1e6, -1e9]), (4, [1e6 + 1, -1e9]), (100, [2.0**40, 2.0**20])]
    rows = [(i, [float(np.float32(v)) for v in x]) for i, x in rows]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk.search_embeddings(df, 100).select("query_id", "rank", "vec_id", "score").collect()
    assert Counter(map(tuple, got)) == plain_top_k(rows, 100, 10)
    assert topk.search_embeddings(df.filter("false")).count() == 0
    assert topk.search_embeddings(df.filter("vec_id = 3")).count() == 0


def test_essential_lists_leave_rows_out():
    """With a good bound, rows that are only in non-essential lists are not scored at all."""
    x = np.zeros((1000, 4))
    x[:10, 0], x[10:, 1:] = 100, 1
    shard = topk.Shard(np.arange(1000), np.arange(1000), np.ones(1000, bool), x.ravel(), np.full(1000, 4))
    at, scores = shard.search(np.array([10.0, 1, 1, 1]), 500)
    assert at.tolist() == list(range(10)) and set(scores.tolist()) == {1000}


# --- conversations ---------------------------------------------------------

WHITE = " \t\n\x0b\f\r"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if h == 1:
            text = ""
        if h == 2:
            text = re.sub("[.!?]", "", text)
        if h == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    return out


def plain_faults(own):
    """Rows in order, each with its first fault."""
    own = sorted(own, key=lambda r: (r[1] is not None, r[1] or 0, hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()))
    seen, out = set(), []
    for _, _, role, text in own:
        bare = text.rstrip(WHITE)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def plain_repair(rows):
    """The cheapest edits, then the ASCII-least ones, over all sequences kept as (cost, edits) per state."""
    roles = {0: "user", 1: "user", 2: "assistant", 3: "user"}
    after = {"u": 2, "a": 3}
    now = {0: (0, "", ())}

    def better(d, s, v):
        if s not in d or v < d[s]:
            d[s] = v

    def inserted(d):
        for _ in range(3):
            for s, (c, e, x) in list(d.items()):
                better(d, after[roles[s][0]], (c + 2, e + "I", (*x, f"{roles[s]}:")))
        return d

    for role, text, fault in rows:
        now, new = inserted(dict(now)), {}
        for s, (c, e, x) in now.items():
            better(new, s, (c + 3, e + "D", x))
            if fault in ("blank", "duplicate"):
                continue
            c += fault == "truncated"
            better(new, after[roles[s][0]], (c + 2, e + "R", (*x, f"{roles[s]}:{text}")))
            i = role[:1]
            if (i == "s" and s == 0) or (i == "u" and s in (0, 1, 3)) or (i == "a" and s == 2):
                better(new, {"s": 1, "u": 2, "a": 3}[i], (c, e + "K", (*x, f"{role}:{text}")))
        now = new
    now = inserted(dict(now))
    return min(now[s] for s in (0, 3) if s in now)


def plain_conversations(original, damaged):
    own = defaultdict(list)
    for r in damaged:
        own[r[0]].append(r)
    out = []
    for conv in {r[0] for r in original}:
        rows = plain_faults(own[conv])
        turns = [r[1] for r in own[conv] if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        n = Counter(r[2] for r in rows)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
        cost, edits, text = plain_repair(rows)
        out.append((conv, gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, edits, hashlib.sha256("\n".join(text).encode()).hexdigest()))
    return Counter(out)


def talk(seed, convs, most):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "s", "u", "a", "tool", "", None, "Ünbekannt"]
    said = ["Yes.", "No!", "why?", "cut off", "", " \n", None, "end. \t", "x.\x85", "Ä.", "long " * 50 + "."]
    out = []
    for c in range(convs):
        for t in range(rng.randint(1, most)):
            out.append((None if c == 3 else c, None if rng.random() < 0.05 else rng.randint(-2, 5) if rng.random() < 0.2 else t,
                        rng.choice(roles[:2] if rng.random() < 0.7 else roles), rng.choice(said) if rng.random() < 0.5 else f"Said {t}."))
    return out


COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def test_conversations_equal_plain_repair(spark):
    ship(spark)
    rows = talk(1, 60, 40) + [(1000, t, "user" if t % 2 else "assistant", f"Turn {t % 700}.") for t in range(3000)]
    rows += [(2000, 1, "user", "Same."), (2000, 1, "user", "Same.")] * 40
    df = clash(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4))
    got = convrepair.repair_digests(df, convrepair.damaged(df)).select(*COLUMNS)
    assert Counter(map(tuple, got.collect())) == plain_conversations(rows, plain_damage(rows))
    assert convrepair.repair_digests(df.filter("false"), convrepair.damaged(df.filter("false"))).count() == 0


def test_conversations_of_the_tables(spark):
    df = table(spark, SF, "conversations")
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    got = queries.op12_conversation_repair(spark, SF).select(*COLUMNS)
    assert Counter(map(tuple, got.collect())) == plain_conversations(rows, plain_damage(rows))


def test_repaired_turns_are_given(spark):
    rows = [(7, 0, "system", "Be good."), (7, 1, "assistant", "Hello."), (7, 2, "user", "Hm"), (7, 3, "user", " ")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = [(r.edit, r.role, r.text) for r in convrepair.repair(df).orderBy("step").collect()]
    cost, edits, text = plain_repair(plain_faults(rows))
    assert "".join(g[0] for g in got) == edits
    assert tuple(f"{g[1]}:{g[2]}" for g in got if g[0] != "D") == text


def test_blocks_of_any_length_walk_alike():
    """Matrices of blocks compose to the costs of the whole, wherever it is cut."""
    rng, step = random.Random(5), convrepair.Steps()
    for _ in range(200):
        codes = bytes(rng.randrange(16) for _ in range(rng.randint(1, 30)))
        v = convrepair.LAST
        for c in reversed(codes):
            v = step(c, v)
        cut = rng.randint(0, len(codes))
        parts = [convrepair.matrix(p, step) for p in (codes[:cut], codes[cut:])]
        assert convrepair.applied(parts[0], convrepair.applied(parts[1], convrepair.LAST)) == v
        whole, _ = convrepair.walk(codes, convrepair.LAST, 0, True, step)
        middle = convrepair.applied(parts[1], convrepair.LAST)
        head, state = convrepair.walk(codes[:cut], middle, 0, False, step)
        assert head + convrepair.walk(codes[cut:], convrepair.LAST, state, True, step)[0] == whole


# --- tokens ----------------------------------------------------------------

A, B = queries.tokenizer_path(), queries.tokenizer_path(queries.PIECES)
TEXTS = [
    (1, "The quick brown fox."), (2, "The quick brown fox."), (3, None), (4, ""), (5, "  two  spaces \n\n and lines\t"), (6, "Ünïcödé ß 漢字 🙂 é"),
    (7, "<|endoftext|> and <s> as plain text <|endoftext|>"), (8, "a ▁ sign of spaces"), (9, "x" * 3000), (None, "no id"), (10, " "), (11, "\x00\x7f\u0085"),
    (12, " ".join(f"w{i * 7919 % 401}" for i in range(9000))), (13, "漢字" * 4000), (12, "a second row of one id"), (14, "<0x41> <unk>"),
]


def plain_alignment(rows):
    """Each document's groups and links by looking at every pair of tokens within a group."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    back = {chr(c): c for c in crosstoken.PRINTABLE} | {chr(256 + i): c for i, c in enumerate(c for c in range(256) if c not in crosstoken.PRINTABLE)}
    docs = []
    for doc_id, text in rows:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a = [bytes(back[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not text or not b"".join(bytes_a) == b"".join(bytes_b) == b" " + text.encode():
            docs.append((doc_id, [], [], [], []))
            continue
        ends_a, ends_b = (list(itertools.accumulate(map(len, x))) for x in (bytes_a, bytes_b))
        shared = sorted(set(ends_a) & set(ends_b))
        groups, links, i, j = [], [], 0, 0
        for end in shared:
            p, q = i, j
            while i < len(ends_a) and ends_a[i] <= end:
                i += 1
            while j < len(ends_b) and ends_b[j] <= end:
                j += 1
            groups.append(f"{','.join(map(str, ids_a[p:i]))}|{','.join(map(str, ids_b[q:j]))}")
            links += [(ids_a[x], ids_b[y]) for x in range(p, i) for y in range(q, j)
                      if max(ends_a[x] - len(bytes_a[x]), ends_b[y] - len(bytes_b[y])) < min(ends_a[x], ends_b[y])]
        docs.append((doc_id, ids_a, ids_b, groups, links))
    count = Counter(pair for d in docs for pair in set(d[4]))
    top = defaultdict(int)
    for (x, _), n in count.items():
        top[x] = max(top[x], n)
    return Counter((d, len(x), len(y), len(g), len(z), sum(count[p] == top[p[0]] for p in z), sum(count[p] for p in z),
                    hashlib.sha256(";".join(g).encode()).hexdigest() if x else "") for d, x, y, g, z in docs)


DIGEST = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize(("chunk", "broadcast"), [(1 << 16, crosstoken.PAIRS), (300, crosstoken.PAIRS), (7, 0), (1 << 16, 0)])
def test_alignment_equals_plain_one(spark, chunk, broadcast):
    ship(spark)
    df = clash(spark.createDataFrame(TEXTS, "doc_id long, text string").repartition(3))
    got = crosstoken.align_digests(df, A, B, chunk, broadcast).select(*DIGEST)
    rows = [(d, t) for d, t in TEXTS]
    assert Counter(map(tuple, got.collect())) == plain_alignment(rows)


def test_alignment_of_the_tables(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").select("doc_id", "text").collect()]
    got = queries.op13_token_alignment(spark, SF).select(*DIGEST)
    assert Counter(map(tuple, got.collect())) == plain_alignment(rows)


def test_alignment_of_no_rows(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert crosstoken.align_digests(df, A, B).count() == 0


def test_fragments_compose_in_any_order():
    t = crosstoken.tokenizers(A, B)
    text = "Composing fragments in any order: straßenbahn, 漢字 and so on. " * 5
    a, _ = t.ids_a([text])
    b, _ = t.ids_b([text])
    tokens = crosstoken.Tokens(a, np.cumsum(t.of_a.size[a]), b, np.cumsum(t.of_b.size[b]))
    end = int(tokens.a_end[-1])
    want = crosstoken.results(tokens, tokens.a_end[-1:], t.ids)["groups"][0]
    rng = random.Random(3)
    for _ in range(60):
        cuts = [-1, *sorted(rng.sample(range(1, end), rng.randint(1, 40))), end]
        parts = [crosstoken.Fragment.of(tokens.part(x, y), t.ids) for x, y in itertools.pairwise(cuts)]
        while len(parts) > 1:
            i = rng.randrange(len(parts) - 1)
            parts[i : i + 2] = [parts[i].then(parts[i + 1], t.ids)]
        whole = parts[0].whole(t.ids)
        assert whole.text[1:] == want and not len(parts[0].tail.a)
