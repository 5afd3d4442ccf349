import hashlib
import random

import numpy as np
import pytest

from versus.llm import lcp


def phrases(data: bytes, levels=3):
    """``(start, end, name)`` in bytes of the phrases of each level."""
    sym, at = np.frombuffer(data, np.uint8), np.array([0])
    where = np.arange(len(data))
    out = []
    for _ in range(levels):
        sym, at, heads = lcp.level_up(sym, at)
        where = where[heads]
        ends = np.append(where[1:], len(data))
        out.append(list(zip(where.tolist(), ends.tolist(), sym.tolist())))
    return out


def text(rng, n):
    return " ".join(rng.choice(["the", "and", "tion", "ererth", "onand", "haaaa", "ing", "é", "wh"]) for _ in range(n)).encode()


@pytest.mark.parametrize("seed", range(8))
def test_equal_substrings_share_interior_phrases(seed):
    rng = random.Random(seed)
    shared = text(rng, 400)
    a, b = text(rng, 37) + b"#" + shared + b"?" + text(rng, 20), text(rng, 3) + shared + text(rng, 50)
    pa_, pb = a.index(shared), b.index(shared)
    for level, margin in zip(range(3), (40, 120, 360)):
        inner = [{(s - p, e - p, n) for s, e, n in phrases(x)[level] if s >= p + margin and e <= p + len(shared) - margin} for x, p in ((a, pa_), (b, pb))]
        assert len(inner[0]) > 5
        assert inner[0] == inner[1]


def test_phrase_lengths_and_names():
    rng = random.Random(3)
    for data in (text(rng, 500), b"a" * 500, b"ab" * 300, bytes(rng.randrange(256) for _ in range(2000))):
        for level, found in enumerate(phrases(data)):
            assert found[0][0] == 0 and found[-1][1] == len(data)
            names = {}
            for s, e, n in found:
                assert names.setdefault(n, data[s:e]) == data[s:e]  # a name stands for one string


def test_batches_do_not_touch_each_other():
    rng = random.Random(5)
    texts = [text(rng, rng.randint(0, 80))[: rng.randint(0, 300)] for _ in range(200)] + [b"", b"x", b"xx", b"xy"]
    together = lcp.sketches(texts)
    for t, row in zip(texts, together):
        assert (lcp.sketches([t])[0] == row).all()


def test_likeness_estimates_shared_phrases():
    rng = random.Random(9)
    a, b = text(rng, 600), text(rng, 600)
    got = lcp.likeness(lcp.sketches([a, a, a + b]), lcp.sketches([a, b, a]))
    assert got[0] == 1 and got[1] < 0.4 and 0.2 < got[2] < 0.9


def test_whole_table_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(5)
    rows = sorted(((r.doc_id, r.text) for r in docs.collect()), reverse=True)
    got = {r.doc_id: r for r in lcp.edit_likeness(docs).collect()}
    assert len(got) == len(rows)
    for i, (doc, t) in enumerate(rows):
        nxt = rows[(i + 1) % len(rows)][1]
        half = len(t) // 2
        new = "".join(list(t)[: len(t) - half] + list(nxt)[:half])
        g = got[doc]
        a, b, c = lcp.sketches([t.encode(), new.encode(), nxt.encode()])
        assert g.n_chars == len(t)
        assert g.edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        assert g.fingerprint == a.astype(">u2").tobytes().hex()
        assert g.edited_fingerprint == b.astype(">u2").tobytes().hex()
        assert g.near_edited == pytest.approx(float(lcp.likeness(a[None], b[None])[0]))
        assert g.near_next == pytest.approx(float(lcp.likeness(a[None], c[None])[0]))


SCHEMA = "doc_id long, text string, fingerprint int, part string"


def test_edge_cases(spark):
    rng = random.Random(2)
    long_text = text(rng, 400_000).decode()
    rows = [(1, None), (2, ""), (3, "é"), (3, "é"), (4, long_text), (None, "no id"), (9, "same text"), (8, "same text")]
    df = spark.createDataFrame([(*r, 1, "p") for r in rows], SCHEMA)
    got = lcp.edit_likeness(df).collect()
    assert len(got) == len(rows)
    assert len({r.fingerprint for r in got if r.doc_id in (8, 9)}) == 1
    assert [r.near_next for r in got if r.doc_id == 9] == [1.0]
    assert [r.near_next for r in got if r.doc_id == 2] == [1.0]  # empty and null
    last = next(r for r in got if r.doc_id is None)  # the first row follows: "same text"
    assert last.edited_sha256 == hashlib.sha256(b"no sa").hexdigest()
    assert lcp.edit_likeness(spark.createDataFrame([], SCHEMA)).count() == 0
    (one,) = lcp.edit_likeness(spark.createDataFrame([(1, "abcd", 1, "p")], SCHEMA)).collect()
    assert one.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and one.near_next == 1.0
    prints = lcp.fingerprints(df).collect()
    assert {r.fingerprint for r in prints if r.doc_id == 8} == {r.fingerprint for r in got if r.doc_id == 8}
