import hashlib
import zlib

import pytest

from versus.llm import merkle
from versus.llm.merkle import fold, manifest, verified

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, g string, idx int, hash string"


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf_of(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]))


def up(level):
    """Levels of a tree from its leaves to its root."""
    levels = [level]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h("".join(last[i:i + 3])) for i in range(0, len(last), 3)])
    return levels


def way_of(levels, i):
    out = []
    for level in levels[:-1]:
        run = i - i % 3
        out.append(("".join(level[run:i]), "".join(level[i + 1:run + 3])))
        i //= 3
    return out


def plain(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    keys = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for k in keys:
        groups[k].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees.append(up([leaf_of(r) for r in groups[k]]))
    over = up([t[-1][0] for t in trees])
    root, out = over[-1][0], []
    for j, k in enumerate(keys):
        for i, r in enumerate(groups[k]):
            way = way_of(trees[j], i) + way_of(over, j)
            text = r[4]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            acc = leaf_of((*r[:4], text))
            for a, b in way:
                acc = h(a + acc + b)
            out.append((r[0], leaf_of(r), trees[j][-1][0], root, h("".join(a + b for a, b in way)), acc, acc == root))
    return sorted(map(repr, out))


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)


def got(df):
    return sorted(repr(tuple(r)) for r in df.collect())


ODD = [(None, "a", "en", 1, "t\n"), (None, "a", "en", 1, "t\n"), (None, None, None, None, None), (1, None, "en", 3, "\n"), (1, None, "en", 3, "\n"),
       (1, None, "en", 3, "other\n"), (-5, "", "", 0, ""), (2, "é", "fr", 5, "é\nü"), (3, "z", None, 1, "1:1\n"), (4, "z", "en", None, "very long\n" * 200_000),
       *[(i, "a", "en", i, f"line {i}\n") for i in range(40)], *[(7, "b", "en", 7, "same\n")] * 20]


def test_odd_rows_equal_plain_trees(spark):
    assert got(verified(frame(spark, ODD))) == plain(ODD)


def test_small_blocks_and_many_rounds(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", 2)
    monkeypatch.setattr(merkle, "SALT_LEVELS", 1)
    rows = [(i, "hot", "en", i, f"{i}\n") for i in range(700)] + [(i, f"s{i % 11}", "de", i, f"{i}") for i in range(300)]
    assert got(verified(frame(spark, rows))) == plain(rows)


def test_one_large_group(spark):
    rows = [(i, "only", "en", i, f"{i}\n" if i % 3 else None) for i in range(2500)]
    assert got(verified(frame(spark, rows))) == plain(rows)


def test_every_changed_field_is_found(spark):
    rows = ODD[2:30]
    base = manifest(frame(spark, rows)).select("doc_id", "leaf", "root", "way")
    assert base.filter(fold(base.leaf, base.way) != base.root).isEmpty()
    other = base.select(merkle.F.concat(base.leaf.substr(1, 63), merkle.F.lit("g")).alias("leaf"), "way", "root")
    assert other.filter(fold(other.leaf, other.way) == other.root).isEmpty()


@pytest.mark.parametrize("rows", [[], [(1, None, "en", 1, "a\n")]])
def test_none_and_one(spark, rows):
    out = verified(frame(spark, rows))
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert got(out) == (plain(rows) if rows else [])
