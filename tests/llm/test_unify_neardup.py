import itertools
import random

import numpy as np
import pytest

from folioscan.llm import neardup, pairs, queries, unify


def test_common_form():
    same = ["Ａ保险 金额\u200b12", "A保险金额12", "\u0410保险\u3000金额１２", "A保\u00ad险\u00a0金\n额12"]
    assert len({unify.common_form(t) for t in same}) == 1
    assert unify.common_form("cafe\u0301") == unify.common_form("café") == "café"
    assert unify.common_form("⼈⼝") == "人口" and unify.common_form("ﬁn") == "fin"
    assert unify.common_form("Abc") != unify.common_form("abc")
    assert unify.common_form("Straße", fold_case=True) == unify.common_form("STRASSE", fold_case=True)
    assert unify.common_form(" a \n b ", keep_spaces=True) == "a b"
    assert unify.common_form("\u03f9\u03f2\u03f3\u037f") == "CcjJ"  # look-alikes whose normal form is another letter
    for c in "\ufff0\ufff8\U0001bca2\U0001d175\u2065":
        assert unify.common_form(f"a{c}b") == "ab"
    for t in [*same, "ё ї \u00b4", "Ⅷ½"]:
        assert unify.common_form(unify.common_form(t)) == unify.common_form(t)


LONG = "关于保险金额与现金价值的说明文本，需要足够长以便参与比较，总计三十个以上字符。"


def chunk_rows(spark, rows):
    return spark.createDataFrame(rows, "ord long, chunk_id string, text string, form_hi string, similarity int")


def test_twins_and_unify(spark):
    rows = [(1, "a", LONG, "x", 1), (2, "b", LONG + "\u200b", "x", 1), (3, "c", LONG, None, None), (3, "c", LONG, None, None), (4, "d", None, "x", 1), (5, "e", "", "x", 1), (6, "f", "短", "x", 1), (7, "g", "短 ", "x", 1)]
    df = chunk_rows(spark, rows)
    got = {tuple(r) for r in unify.differing_twins(df).collect()}
    assert got == {("a", "b"), ("b", "c")}
    assert unify.differing_twins(df.limit(0)).count() == 0
    out = {r.chunk_id: r.text_form for r in unify.unify(df, ["text"]).collect()}
    assert out["d"] is None and out["e"] == "" and out["a"] == out["b"]


def test_unified_chunks_are_one_row_each(spark, tmp_path):
    rows = [("a", "x\u200b", None), ("a", "x\u200b", None), ("b", None, "\u0410" * 3_000_000), (None, "1", "1"), (None, "2", "")]
    spark.createDataFrame(rows, "chunk_id string, text string, retrieval_text string").write.parquet(str(tmp_path / "chunks.parquet"))
    got = [tuple(r) for r in queries.p5_unified(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted([("a", "x", None), ("b", None, "A" * 3_000_000), (None, "1", "1"), (None, "2", "")], key=str)


def brute(texts, bag, least, shingle=5, min_length=30):
    forms = {k: unify.common_form(t) for k, t in texts.items() if t}
    forms = {k: f for k, f in forms.items() if len(f) >= min_length}
    return {(a, b) for a, b in itertools.combinations(sorted(forms), 2) if neardup.similarity(forms[a], forms[b], shingle, bag) >= least}


@pytest.mark.parametrize("bag", [False, True])
def test_pairs_equal_brute_force(spark, bag):
    rng = random.Random(3)
    letters = [chr(0x4E00 + i) for i in range(400)]
    base = ["".join(rng.choices(letters, k=rng.randint(35, 160))) for _ in range(25)]
    texts = {}
    for i, t in enumerate(base):
        for j in range(rng.randint(1, 4)):
            s = list(t)
            for _ in range(rng.randint(0, 4) if j else 0):
                s[rng.randrange(len(s))] = rng.choice(letters)
            texts[f"t{i}_{j}"] = "".join(s) + ("。" * 40 if bag and j == 2 else "")
    texts |= {"empty": "", "null": None, "short": "短文", "huge": "".join(rng.choices(letters, k=60_000)), "copy": base[0]}
    rows = [(i, k, t, None, None) for i, (k, t) in enumerate(texts.items())]
    df = chunk_rows(spark, rows + rows[:3])
    got = [tuple(r) for r in neardup.near_pairs(df, bag=bag, bands=128, rows=4).collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute(texts, bag, 0.6)


def test_groups(spark):
    rows = [(1, "a", LONG, None, None), (2, "b", LONG, None, None), (3, "c", LONG[:-3] + "位字符", None, None), (4, "d", LONG[::-1], None, None), (5, "e", None, None, None)]
    got = {r.chunk_id: (r.class_id, r.group_id) for r in neardup.near_groups(chunk_rows(spark, rows)).collect()}
    assert got == {"a": (1, 1), "b": (1, 1), "c": (3, 1), "d": (4, 4)}
    assert neardup.near_pairs(chunk_rows(spark, []), bands=8).count() == 0
    assert neardup.near_groups(chunk_rows(spark, []), bands=8).count() == 0


def test_groups_equal_brute_force_links(spark):
    """Chains whose ends are far apart share buckets with their middle: groups are those of all links."""
    rng = random.Random(8)
    letters = [chr(0x4E00 + i) for i in range(300)]
    texts = {}
    for i in range(12):
        s = rng.choices(letters, k=rng.randint(60, 120))
        for j in range(rng.randint(1, 9)):
            texts[len(texts)] = "".join(s)
            at = rng.randrange(len(s) - 8)
            s[at : at + 8] = rng.choices(letters, k=8)  # each step drifts further from the first
    df = chunk_rows(spark, [(k, f"t{k}", t, None, None) for k, t in texts.items()])
    links = brute(texts, True, 0.6)
    root = {k: k for k in texts}
    for _ in texts:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    got = {int(r.chunk_id[1:]): r.group_id for r in neardup.near_groups(df, bag=True, bands=200, rows=3).collect()}
    assert got == root and len(set(root.values())) < len(root)


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(1)
    element = neardup.mix(np.arange(300, dtype=np.uint64) + np.uint64(7))
    w1, w2 = rng.integers(0, 9, 300), rng.integers(0, 9, 300)
    owner = np.repeat([0, 1], 300)
    weights = np.concatenate([w1, w2]).astype(float)
    keep = weights > 0
    grid = neardup.bag_signatures(owner[keep], np.concatenate([element, element])[keep], weights[keep], 2, 4096)
    truth = np.minimum(w1, w2).sum() / np.maximum(w1, w2).sum()
    assert abs((grid[0] == grid[1]).mean() - truth) < 0.03


def test_hot_group_is_split(spark):
    rows = spark.range(60).selectExpr("1 AS g", "id").unionByName(spark.range(100, 102).selectExpr("2 AS g", "id")).unionByName(spark.sql("select cast(null as int) g, cast(7 as long) id"))
    got = pairs.pairs_within(rows, ["g"], "id", part_rows=7)
    assert got.count() == 60 * 59 // 2 + 1 and got.distinct().count() == got.count()


def test_hot_classes_meet_in_parts(spark):
    left = spark.range(3).selectExpr("id % 2 AS k", "id AS x", "50L AS n")
    right = spark.range(100).selectExpr("id % 2 AS k", "id AS y", "50L AS n")
    got = pairs.pairs_across(left, right, ["k"], "n", "y", part_rows=7)
    assert got.count() == 150 and got.select("x", "y").distinct().count() == 150


def test_linked_groups(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(40)] + [(100 + rng.randrange(30), 100 + rng.randrange(30)) for _ in range(25)] + [(500, 500), (None, 3)]
    got = dict(tuple(r) for r in pairs.linked_groups(spark.createDataFrame(links, "a long, b long"), "a", "b").collect())
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    assert got == {x: find(x) for x in list(parent)}
