import random
import re
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioscan.llm import markup, mixture, queries, relevance, repetition, splitting, tokens, wrappers

MARKED = [
    "a<br/>b", "x <b>y", "<H1 class='t'>节</H1>", "a <!-- 注 --> b", "a &nbsp; b", "&#12288;", "&lt;em&gt;x&lt;/em&gt;", "## 标题", "甲**乙丙**丁", "~~删~~", "[甲](../a/b.md)", "![](pic/a.png)",
    "注[^1]", "`代码`", "```\nx\n```", "> 引", "| a | b |\n|---|---|\n| 1 | 2 |", "[[链接|字]]", "{{模板|值}}", "== 节 ==", "'''粗'''", "{|\n|-\n| a || b\n|}", "__NOTOC__", "甲\\textbf{乙}丙",
    "<!DOCTYPE html>", "<?xml version='1.0'?>", "<o:p>甲", "<custom a=\"1\">", "</custom>", "{{模板\n|甲=1\n}}", "\\LaTeX 文", "\\xi + \\zeta", "{\\bf x}", "甲[文档][ref]", "\n[ref]: http://a.b/c", "\n\n标题\n====", "f:\\mathbb{R}",
    "|a|b|\n|c|d|", "\\begin{itemize}\n\\item 甲\n\\end{itemize}", "式$x_t = 1$。", "\\[ a^2 \\]", "<ref name=n>注</ref>",
]
PLAIN = [
    "", " ", "A<3 且 B>7", "A->B", "约$500，又约$600，共$1", "[2027]12号", "注[3]", "第#3批", "____", "____和____", "5~7日，8~9日", "R&D；", "{甲}", "doc_no", "C:\\out", "e=mc^2", "以前*，以后*，再*",
    "丙类|丁类", "a = b == c", "x_1 和 y_2", "3*4*5", "2*(3+1)*4", "国发[2023](12)号", "见[1](2)", "[1][2]", "|x|+|y|", "if a <i and j> 0", "C:\\alpha\\beta", "路径 \\\\srv\\share\\dir", "dir\\file\\name", "\\u4e2d\\u6587", "甲\n乙\n----\n丙", "A<B 且 C>D", "1 < 2 > 0", "路径 /a/b_c/d", "- 项", "a'b''",
]


@pytest.mark.parametrize("text", MARKED)
def test_markup_found(text):
    assert markup.tokens("前文" + text if not re.match(r"[#>|={`\\<]|\{\|", text) else text)


@pytest.mark.parametrize("text", PLAIN)
def test_plain_signs_are_no_markup(text):
    assert not markup.tokens(text)
    assert markup.clean(text) == text


def test_clean_keeps_structure():
    text = "<h2>总则</h2><p>甲&amp;乙</p><ul><li>一<li>二</ul>\n\\section{附则}\n| 项 | 期 |\n|---|---|\n| a | 1 |\n```\nx = '''1'''\n```\n\\[ a_1 \\]\n[[分类|见]]{{注|丙}}__NOTOC__**粗**"
    out = markup.clean(text)
    for part in ("## 总则", "甲&乙", "- 一", "- 二", "# 附则", "| 项 | 期 |", "| a | 1 |", "```\nx = '''1'''\n```", "$a_1$", "见丙粗"):
        assert part in out, part
    assert "---" not in out and "<" not in out and "__" not in out


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab 甲乙\n<>/*_~`#|[](){}\\$&;='!^-:.", max_size=80))
def test_clean_never_fails(text):
    markup.clean(text)
    wrappers.of_stream(x for x, _, _ in markup.stream(text, markup.tokens(text)))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab0 9\n<>/`$\\{}&;\ue000\ue001", max_size=60))
def test_characters_of_marks_are_kept(text):
    assert re.findall("[\ue000\ue001]", markup.clean("<br>" + text.replace("<", "").replace("{", "").replace("$", "").replace("&", "").replace("\\", ""))) == re.findall("[\ue000\ue001]", text)
    markup.clean("<br>" + text)


def test_clean_of_deep_residue():
    assert markup.clean("&" + "amp;" * 9 + "lt;b&" + "amp;" * 9 + "gt;x &amp;amp;amp; y") == "x & y"
    deep = "\\emph{" * 500 + "甲" + "}" * 500
    assert markup.clean(deep) == "甲"
    assert markup.clean("见\\cite{a}~乙\\footnote{注\\emph{丙}}，\\href{http://x}{字}") == "见乙（注丙），字"
    assert markup.clean("标题\n====\n\\noindent\\alpha 与 {\\bf 粗}") == "# 标题\n$\\alpha$ 与 粗"
    assert markup.clean("\ue0009\ue001 <br> `\ue0000\ue001`") == "\ue0009\ue001 \n `\ue0000\ue001`".replace(" \n", "\n")


def wrapper(*streams):
    made = [wrappers.of_stream(s.split()) for s in streams]
    out = made[0]
    for w in made[1:]:
        out = wrappers.align(out, w)
    assert wrappers.loaded(wrappers.dumped(out)) == out
    return wrappers.written(out)


def test_wrappers_of_streams():
    assert wrapper('<h2> "a" </h2> "x" <hr> "脚"', '<h2> "b" </h2> "y" <b> "z" </b> <hr> "脚"') == '<h2> # </h2> # #? </b>? <b>? <hr> "脚"'
    assert wrapper("<li> # <li> #") == "(<li> #)+" == wrapper("<li> # <li> #", "<li> #", "<li> # <li> # <li> #")
    assert wrapper("<p> #", "#") == "<p>? #" and wrapper("<b> # <i> # <b>", "#").count("#") >= 1
    assert wrapper('"a"', '"a"') == '"a"' and wrapper('"a"', '"b"') == "#" and wrapper("", "<b> #") == "#? <b>?"
    many = wrapper(*(" ".join(random.Random(i).choices(["<b>", "#", "<i>", "md_code"], k=300)) for i in range(6)))
    assert len(many.split()) < 2000 and "#" in many


def accepts(w, symbols):
    """Whether the regular expression that a wrapper stands for has a stream; a gap is its tokens in any order."""
    of = {}

    def sign(s):
        return of.setdefault(s, chr(0x4E00 + len(of)))

    texts = "".join(sign(s) for s in {*wrappers.symbols(w), *symbols} if wrappers.is_text(s))

    def signs(s):
        return f"[{texts}]" if s == "#" else sign(s)

    def pattern(nodes, gaps):
        bags = [(("[" + "".join(signs(s).strip("[]") for s in g) + "]") + ("?" if list(g.values()) == [False] else "*")) if g else "" for g in gaps]
        return bags[0] + "".join((signs(s) if isinstance(s, str) else f"(?:{pattern(*s)})") + "+" * r + bag for (s, r), bag in zip(nodes, bags[1:]))

    return re.fullmatch(pattern(*w), "".join(sign(s) for s in symbols)) is not None


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["<u>", "</u>", "<l>", "</l>", "<b>", '"a"', '"b"', '"c"']), max_size=14), min_size=1, max_size=5))
def test_wrappers_hold_all_their_streams(streams):
    out = wrappers.of_stream(streams[0])
    for s in streams[1:]:
        out = wrappers.align(out, wrappers.of_stream(s))
    assert wrappers.loaded(wrappers.dumped(out)) == out
    for s in streams:
        assert accepts(out, s), (wrappers.written(out), s)


def test_wrappers_of_long_streams():
    for seed in range(8):
        rng = random.Random(seed)
        streams = [rng.choices(["<b>", "</b>", "<i>", "</i>", "<br>", '"a"', '"b"', "#"], k=800) for _ in range(3)]
        out = wrappers.of_stream(streams[0])
        for s in streams[1:]:
            out = wrappers.align(out, wrappers.of_stream(s))
        assert wrappers.symbols(out) >= {x for s in streams for x in s if not wrappers.is_text(x)}


def test_wrappers_find_squares():
    def of(*texts):
        return wrapper(*(" ".join(s.replace(" ", "_") for s, _, _ in markup.stream(t, markup.tokens(t))) for t in texts))

    assert of("<ul><li>一<li>二</ul>", "<ul><li>三<li>四<li>五</ul>") == "<ul> (<li> #)+ </ul>"
    assert of("<ul><li>一</ul>", "<ul><li>二<li>三<li>四</ul>") == "<ul> (<li> #)+ </ul>" == of("<ul><li>二<li>三<li>四</ul>", "<ul><li>一</ul>")
    wide = "".join(f"<b>甲{i}</b><i>乙{i}</i><br>" for i in range(3))
    assert of(wide, "<b>丙</b><i>丁</i><br>") == "(<b> # </b> <i> # </i> <br>)+"  # seven nodes wide
    for more in ("<li>一</li><li><b>二</b></li>", "<li><b>二</b></li><li>一</li>", "<li>三</li><li><b>二</b></li><li>四</li>"):
        assert of(f"<ul>{more}</ul>", "<ul><li>三</li></ul>") == "<ul> (<li> <b>? # </b>? </li>)+ </ul>"
    items = "".join(f"<li><b>{i}</b></li>" if i in (0, 2) else f"<li>{i}</li>" for i in range(6))
    assert of(f"<ul>{items}</ul>", "<ul><li>二</li></ul>") == "<ul> (<li> <b>? # </b>? </li>)+ </ul>"  # one square, not the pairs of two
    assert of("<tr><td>a</td><td>b</td></tr><tr><td>c</td></tr>", "<tr><td>x</td></tr>") == "(<tr> (<td> # </td>)+ </tr>)+"
    assert of("<h2>制度</h2>一<h2>附则</h2>二", "<h2>制度</h2>三<h2>附则</h2>四") == '<h2> "制度" </h2> # <h2> "附则" </h2> #'  # no mismatch of markup


def test_long_streams_are_aligned_as_a_whole():
    rng = random.Random(5)
    a = [rng.choice(["<b>", "<i>", '"x"', '"y"']) for _ in range(60)]
    b = [rng.choice(["<b>", "<i>", '"x"', '"z"']) for _ in range(45)]

    def score(pairs):
        assert all(i < k and j < n for (i, j), (k, n) in zip(pairs, pairs[1:]))
        return sum(3 if a[i] == b[j] else 1 for i, j in pairs)

    want = score(wrappers._matches(a, b))
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(wrappers, "MOST_CELLS", 40)
        assert score(wrappers._matches(a, b)) == want


def test_wrappers_of_hosts(spark):
    said = [f"<h2>题{i}</h2>\n正文{'甲乙丙丁'[i % 4]}{i}。\n<hr>本页由系统自动生成" for i in range(12)]
    rows = [("h", t) for t in said] + [(None, "甲"), (None, None), ("g", "本页由系统自动生成")]
    df = spark.createDataFrame([(i, h, t) for i, (h, t) in enumerate(rows)], "id long, host string, text string").repartition(4)
    for fan in (2, 64):
        found = markup.host_wrappers(df, fan=fan)
        got = {r.host: (r.wrapper, r.n_texts) for r in found.collect()}
        assert got["h"] == ('<h2> # </h2> # <hr> "本页由系统自动生成"', 12) and got[None][1] == 2 and got["g"] == ('"本页由系统自动生成"', 1)
    cleaned = {r.id: r for r in markup.cleaned_texts(df, found, "id").collect()}
    assert cleaned[0].clean_text == "## 题0\n\n正文甲0。" and cleaned[0].n_template == 1 and cleaned[0].structure == "<h2> # </h2> # <hr> #"
    assert cleaned[12].clean_text == "甲" and cleaned[13].clean_text is None and cleaned[14].clean_text == "本页由系统自动生成"  # one text makes no template
    assert len(cleaned) == 15 and markup.host_wrappers(df.limit(0)).count() == 0


def test_found_by_wrappers(spark, tmp_path):
    rows = [("a", "d1", "<ul><li>一<li>二</ul>"), ("b", "d1", "甲"), ("c", "d1", "R&amp;D"), ("d", "d2", "x <br> y"), ("d", "d2", "平文"), ("e", "d1", None), (None, "d1", "`码`"), (None, None, "乙"), ("f", None, "**粗**")]
    df = spark.createDataFrame(rows, "chunk_id string, doc_id string, text string")
    df.write.parquet(str(tmp_path / "chunks.parquet"))
    spark.sql("select 'd1' doc_id, 'p/q/a.md' source_markdown_path, timestamp_ntz'2026-01-01' indexed_at").write.parquet(str(tmp_path / "document_index.parquet"))
    assert sorted(str(r.chunk_id) for r in queries.p3_found(spark, str(tmp_path)).collect()) == ["None", "a", "c", "d", "f"]
    texts = df.withColumnRenamed("doc_id", "host")
    known = markup.host_wrappers(texts)
    assert markup.found_by_wrappers(texts, known).count() == markup.with_markup(texts).count() == 5
    # it is the wrapper of the host that tells markup from text
    other = known.withColumn("nodes", F.lit(wrappers.dumped(wrappers.of_stream(["#", "<br>", "#"]))))
    assert sorted(r.chunk_id for r in markup.found_by_wrappers(texts, other).collect()) == ["c", "d"]
    assert markup.found_by_wrappers(texts.limit(0), known).count() == 0


def test_markup_rows(spark, tmp_path):
    df = spark.createDataFrame([("a", "x <br> y"), ("a", "x <br> y"), ("b", None), ("c", ""), ("d", "平文"), (None, "甲"), (None, "乙")], "chunk_id string, text string")
    assert [r.chunk_id for r in markup.with_markup(df).collect()] == ["a"]
    df.withColumn("doc_id", F.when(F.col("chunk_id") < "c", "d1")).write.parquet(str(tmp_path / "chunks.parquet"))
    spark.sql("select 'd1' doc_id, 'p/q/a.md' source_markdown_path, timestamp_ntz'2026-01-01' indexed_at").write.parquet(str(tmp_path / "document_index.parquet"))
    out = [(r.chunk_id, r.clean_text) for r in queries.p3_clean(spark, str(tmp_path)).collect()]
    assert sorted(out, key=str) == sorted([("a", "x\n y"), ("b", None), ("c", ""), ("d", "平文"), (None, "甲"), (None, "乙")], key=str)
    assert {r.host: r.n_texts for r in queries.p3_wrappers(spark, str(tmp_path)).collect()} == {"p/q": 2, None: 4}
    assert markup.with_markup(df.limit(0)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="甲乙丙。，\n ab.", min_size=0, max_size=400), st.integers(20, 80), st.integers(0, 9))
def test_pieces_cover_and_fit(text, limit, overlap):
    whole = splitting.squeezed(text)
    cut = splitting.pieces(whole, limit, overlap)
    assert "".join(whole[a:b] for a, b in cut) == whole
    if len(whole) > limit:
        assert all(0 < b - a <= limit - overlap for a, b in cut)


def test_split_rows(spark):
    long = "第一章 总则\n" + "甲乙丙丁，戊己庚辛。" * 300 + "\n\n第二章\n" + "x" * 3000
    df = spark.createDataFrame([("a", long, ["t"], 9), ("a", long, ["t"], 9), ("b", "短" + " " * 2000, None, 1), ("c", None, None, None), ("d", "字" * 1400, None, 0), ("e", "字" * 1401, [], 0)], "chunk_id string, text string, title_path array<string>, piece int")
    rows = splitting.split_oversized(df, keep=["title_path"]).collect()
    assert {r.chunk_id for r in rows} == {"a", "e"}
    a = sorted((r for r in rows if r.chunk_id == "a"), key=lambda r: r.piece)
    assert [r.piece for r in a] == list(range(a[0].n_pieces)) and all(len(r.piece_text) <= 1400 and r.title_path == ["t"] for r in a)
    for before, after in zip(a, a[1:]):
        assert after.piece_text.startswith(before.piece_text[-120:]) and after.core_start == before.core_end
    with pytest.raises(ValueError):
        splitting.split_oversized(df, limit=100, overlap=50)
    assert splitting.split_oversized(df.limit(0)).count() == 0


def test_pieces_keep_the_stored_text(spark, tmp_path):
    block = ("甲" * 95 + "\n    ") * 9
    paragraphs = block[:-5] + "\n \r\n" + block + "止"
    spaced = ("字" + " " * 10) * 200
    rows = [("p", paragraphs), ("s", spaced), ("s", spaced), ("t", "短" + " " * 10), ("n", None), ("e", "")]
    spark.createDataFrame([(k, "d", ["t"], t) for k, t in rows], "chunk_id string, doc_id string, title_path array<string>, text string").write.parquet(str(tmp_path / "chunks.parquet"))
    found = queries.p4_pieces(spark, str(tmp_path)).orderBy("chunk_id", "piece").collect()
    assert {r.chunk_id for r in found} == {"p", "s"}
    for k, text in (("p", paragraphs), ("s", spaced)):
        own = [r for r in found if r.chunk_id == k]
        assert "".join(text[r.core_start : r.core_end] for r in own) == text
        assert all(r.piece_text.endswith(text[r.core_start : r.core_end]) and len(r.piece_text) <= 1400 for r in own)
    p = [r for r in found if r.chunk_id == "p"]
    assert [r.core_end for r in p] == [paragraphs.index("\r\n") + 2, len(paragraphs)]  # at the blank line
    assert {r.chunk_id for r in queries.p4_found(spark, str(tmp_path)).collect()} == {"p"}


def test_codes():
    assert relevance.codes("见DG2554与WCPZ-6463，A-1234，AB-12-34，ABCDEFG1234，ab1234") == ["DG2554", "WCPZ-6463", "AB1234"]


def test_relevance_against_brute_force(spark):
    rows = [("a", "保险 AB1234 x", None), ("a", "保险 AB1234 x", None), ("b", "ＡＢ１２３４ 保险", "t"), ("c", None, "CD5678 CD5678"), ("d", "", ""), ("e", "保险 EF0001", "")]
    df = spark.createDataFrame(rows, "chunk_id string, retrieval_text string, text string")
    got = {tuple(r) for r in relevance.shared_codes(df).collect()}
    assert got == {("a", "AB1234"), ("b", "AB1234")}
    records = {}
    for k, t, _ in rows:
        records[k] = relevance.words(unicodedata.normalize("NFKC", t or ""))
    df_ = defaultdict(int)
    for ts in records.values():
        for t in set(ts):
            df_[t] += 1
    n, mean = len(records), np.mean([len(t) for t in records.values()])
    want = {}
    for k, ts in records.items():
        for t in set(ts):
            tf = ts.count(t)
            want[k, t] = round(float(np.log1p((n - df_[t] + 0.5) / (df_[t] + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len(ts) / mean))), 6)
    found = {(r.chunk_id, r.term): r.score for r in relevance.characteristic_terms(df, "chunk_id", ["retrieval_text"]).collect()}
    assert found == pytest.approx(want)
    assert relevance.shared_codes(df.limit(0)).count() == 0


def test_hot_codes_are_not_shared_codes(spark):
    df = spark.createDataFrame([(f"c{i}", f"见HOT-1234{'，AB1111' if i < 8 else ''}{'，CD2222' if i == 3 else ''}{'，EF3333' if i < 9 else ''}") for i in range(40)], "chunk_id string, retrieval_text string").withColumn("text", F.col("retrieval_text"))
    assert {tuple(r) for r in relevance.shared_codes(df).collect()} == {(f"c{i}", "AB1111") for i in range(8)}


def test_all_terms_of_a_record_are_scored(spark, tmp_path):
    texts = {"a": " ".join(f"wort{i}" for i in range(40)) + " 甲乙丙", "b": " ".join(f"wort{i}" for i in range(0, 40, 3)), "c": None}
    rows = [(k, t, "wort1" if k == "b" else None) for k, t in texts.items()]
    spark.createDataFrame(rows, "chunk_id string, retrieval_text string, section_title string").write.parquet(str(tmp_path / "chunks.parquet"))
    records = {k: relevance.words("\n".join(v for v in (t, s) if v)) for k, t, s in rows}
    df_ = Counter(t for ts in records.values() for t in set(ts))
    mean = np.mean([len(ts) for ts in records.values()])
    want = {}
    for k, ts in records.items():
        for t, tf in Counter(ts).items():
            want[k, t] = (tf, df_[t], round(float(np.log1p((3 - df_[t] + 0.5) / (df_[t] + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len(ts) / mean))), 6))
    found = queries.p6_terms(spark, str(tmp_path)).collect()
    assert len(found) == len(want) == 57
    for head in (None, 0, 5, 14):  # whichever frequencies are broadcast
        rows_ = found if head is None else relevance.record_scores(spark.read.parquet(str(tmp_path / "chunks.parquet")), "chunk_id", ["retrieval_text", "section_title"], head).collect()
        got = {(r.chunk_id, r.term): (r.tf, r.df, r.score) for r in rows_}
        assert len(rows_) == len(got) and got.keys() == want.keys()
        assert all(got[k][:2] == want[k][:2] and got[k][2] == pytest.approx(want[k][2], abs=2e-6) for k in want)
    top = queries.p6_top_terms(spark, str(tmp_path)).collect()
    assert Counter(r.chunk_id for r in top) == {"a": 10, "b": 10}


def test_long_terms_are_terms(spark):
    code, word = "AB" + "1" * 70, "ก" * 200
    df = spark.createDataFrame([("a", f"见{code}，{word}"), ("b", f"{code.lower()} x"), ("c", word)], "chunk_id string, retrieval_text string").withColumn("text", F.lit(None).cast("string"))
    assert {tuple(r) for r in relevance.shared_codes(df).collect()} == {("a", code), ("b", code)}
    for head in (0, 50):
        rows = relevance.record_scores(df, "chunk_id", ["retrieval_text"], head).collect()
        assert {(r.chunk_id, r.term): r.df for r in rows} == {("a", "见"): 1, ("a", code): 2, ("a", word): 2, ("b", code): 2, ("b", "x"): 1, ("c", word): 2}


def test_rows_without_id_stay_apart(spark):
    texts = ["AB1234 eins", "AB1234 zwei drei", "vier"]
    df = spark.createDataFrame([(None, t) for t in texts] + [("a", "CD1234"), ("a", "CD1234")], "chunk_id string, retrieval_text string").withColumn("text", F.col("retrieval_text"))
    assert [tuple(r) for r in relevance.shared_codes(df).collect()] == [(None, "AB1234")] * 2
    rows = relevance.record_scores(df, "chunk_id", ["retrieval_text"]).collect()
    assert sorted(r.term for r in rows) == ["AB1234", "AB1234", "CD1234", "drei", "eins", "vier", "zwei"]
    assert sorted(r.term for r in relevance.characteristic_terms(df, "chunk_id", ["retrieval_text"]).collect()) == sorted(r.term for r in rows)
    pieces = splitting.split_oversized(spark.createDataFrame([(None, "字" * 1401), (None, "词" * 1401), ("a", "句" * 1401), ("a", "句" * 1401)], "chunk_id string, text string")).collect()
    assert Counter(r.piece_text[0] for r in pieces if r.piece == 0) == {"字": 1, "词": 1, "句": 1}
    chunks = df.withColumn("doc_id", F.lit("d"))
    documents = spark.createDataFrame([], "text string, source string, lang string, index_doc_id string")
    index = spark.createDataFrame([], "doc_id string, domain string, indexed_at timestamp_ntz")
    total = tokens.corpus_budget(documents, chunks, index).where("grouping_level = 7").first()
    assert total.n_docs == 4 and total.n_chars == sum(map(len, texts)) + 6


def brute_share(text, width=20):
    bare = re.sub("[ \t\n\r\u00a0\u2000-\u200a\u202f\u3000]+", "", text)
    seen, again = set(), 0
    for i in range(len(bare) - width + 1):
        again += bare[i : i + width] in seen
        seen.add(bare[i : i + width])
    return len(bare), max(0, len(bare) - width + 1), again


def test_repetition_against_brute_force(spark):
    texts = [None, "", "  ", "短", "甲乙丙丁戊己庚辛壬癸" * 12, "".join(chr(0x4E00 + i) for i in range(150)), ("一行重复的文字，足够长以便形成窗口的内容。\n" * 9), "ab" * 50_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in repetition.repetition(df).collect()}
    for i, t in enumerate(texts):
        assert (rows[i].n_chars, rows[i].n_windows, rows[i].n_repeated) == brute_share(t or "")
    assert {r.doc_id for r in repetition.repetitive(df).collect()} == {4, 6, 7}
    assert rows[6].n_failed == 8 and rows[6].rejected and not rows[5].rejected
    assert rows[4].n_failed == 1 and rows[4].n_lost_repeated == 120  # one line that repeats itself
    assert repetition.repetitive(df.limit(0)).count() == 0


@pytest.mark.parametrize("line,failure", [
    ("首页 > 产品 > 寿险", "navigation"), ("Accueil", "navigation"), ("3 likes", "navigation"), ("2024-03-01", "navigation"), ("————", "punctuation"), ("保险责任", None), ("a | b", None),
    ("版权所有，未经许可不得转载", "boilerplate"), ("All rights reserved. " * 30, "boilerplate"), ("本产品的版权所有人为甲公司。投保人应当阅读。保险责任见第三条。", None), ("甲公司与乙公司 | 丙公司的年度报告及其他有关文件的说明", None),
])
def test_line_rules(line, failure):
    assert repetition.line_failure(line.strip()) == failure


def test_lines_are_cleaned_by_themselves():
    said = "保险责任如下所示内容完整，期限为二十年，合计一百万元。"
    assert repetition.clean_lines(f"{said}\n首页 | 目录\n {said}\n短行\n\n短行\n结束语。") == f"{said}\n短行\n结束语。"
    assert repetition.clean_lines("") == "" and repetition.clean_lines(" \n") == ""


@pytest.mark.parametrize("shards,draws", [(1, [5, 0]), (11, [100, 7, 0, 33]), (64, [3, 2]), (1000, [31_000, 900, 100]), (1_000_000, [20_000_000, 0, 11_000_000, 1])])
def test_draws_are_split_exactly(shards, draws):
    zero = np.zeros(len(draws))
    low, high, have, first = mixture.split_draws(0, shards, np.array(draws), zero, 1)
    assert (have.sum(axis=0) == draws).all() and (high == low + 1).all() and len(set(low.tolist())) == len(low)
    assert len(low) == min(shards, sum(draws)) and have.sum(axis=1).max() - have.sum(axis=1).min() <= 1
    for k, n in enumerate(draws):  # every draw is in one shard
        order = np.argsort(first[:, k], kind="stable")
        held = have[order, k] > 0
        assert (np.cumsum(have[order, k])[held] == (first[order, k] + have[order, k])[held]).all()
    top = mixture.split_draws(0, shards, np.array(draws), zero, 1, -(-shards // 16))
    assert len(top[0]) <= 32 and (top[2].sum(axis=0) == draws).all()


def test_draws_beyond_the_exact_generator():
    have = np.array([3 * 10**12, 10**6, 0, 5 * 10**10])
    _, _, parts, _ = mixture.split_draws(0, 7, have, np.zeros(4), 3)
    assert (parts.sum(axis=0) == have).all() and (parts >= 0).all()
    assert np.abs(parts / parts.sum(axis=1, keepdims=True) - have / have.sum()).max() < 1e-3


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000, 4097])
def test_numbers_are_permuted(n):
    out = mixture.permuted(np.arange(n), n, 5)
    assert sorted(out.tolist()) == list(range(n)) and (n < 17 or out.tolist() != list(range(n)))
    assert mixture.permuted(np.arange(n)[::-1], n, 5).tolist() == out[::-1].tolist()


@pytest.mark.parametrize("bits", [1, 12])
def test_last_places(spark, monkeypatch, bits):
    monkeypatch.setattr(mixture, "BIN_BITS", bits if bits > 1 else 5)
    places = [5, 5, 9, 2**40, 2**40 + 1, 2**62 + 7]
    records = spark.createDataFrame([(k, p, 10) for k in (0, 1) for p in places], "source_no int, place long, n_tokens long")
    assert mixture.last_places(records, {0: 1, 1: 60}) == {0: 5, 1: 2**62 + 7}
    assert mixture.last_places(records, {0: 21, 1: 31}) == {0: 9, 1: 2**40}
    assert mixture.last_places(records, {0: 0, 1: 41}) == {1: 2**40 + 1}


@pytest.mark.parametrize("shard_tokens", [50_000, 5_000, 700])
def test_shards_have_one_size(spark, shard_tokens):
    sized = spark.range(9_000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'a' ELSE 'b' END AS source", "10L AS n_tokens")
    targets = spark.createDataFrame([("a", 0.5, 2), ("b", 0.5, 1)], "source string, target_weight double, max_repeats int")
    draws, shares = mixture.mixture(sized, targets, shard_tokens=shard_tokens)
    sizes = [r[1] for r in draws.groupBy("shard").agg(F.sum("n_tokens")).collect()]
    assert len(sizes) == -(-120_000 // shard_tokens) and {r.source: r.drawn_tokens for r in shares.collect()} == {"a": 60_000, "b": 60_000}
    block = 120_000 / len(sizes) / mixture.BLOCKS_A_SHARD
    assert np.std(sizes) <= 4 * block * np.sqrt(mixture.BLOCKS_A_SHARD)  # as many blocks each, of random sizes


def test_mixture(spark):
    rows = [(i, "big" if i % 3 else "Small ", 10 + i % 7) for i in range(600)] + [(1000, None, 5), (1001, "other", 5), (1002, "big", 0), (1003, "hot-one", 900)]
    sized = spark.createDataFrame(rows, "doc_id long, source string, n_tokens long").selectExpr("doc_id", "replace(trim(lower(source)), '-', '_') AS source", "n_tokens")
    targets = spark.createDataFrame([("big", 0.6, 1), ("small", 0.4, 3), ("absent", 0.5, 2), ("nothing", None, None)], "source string, target_weight double, max_repeats int")
    draws, shares = mixture.mixture(sized, targets, shard_tokens=500)
    got = {r.source: r for r in shares.collect()}
    assert abs(got["big"].actual_share - 0.6) < 0.01 and abs(got["small"].actual_share - 0.4) < 0.01
    assert got["absent"].drawn_tokens == 0 and got["nothing"].drawn_tokens == 0
    uses = defaultdict(int)
    places = defaultdict(list)
    for r in draws.collect():
        uses[r.doc_id] += 1
        places[r.shard].append(r.position)
        assert r.source in ("big", "small") and r.n_tokens > 0
    limit = {"big": 1, "small": 3}
    of = {r[0]: r[1] for r in sized.collect()}
    assert all(n <= limit[of[d]] for d, n in uses.items())
    assert all(sorted(p) == list(range(len(p))) for p in places.values()) and len(places) > 5
    empty, none = mixture.mixture(sized.limit(0), targets)
    assert empty.count() == 0 and none.count() == 4
    assert [d.count() for d in mixture.mixture(sized, targets.limit(0))] == [0, 0]
    nameless = spark.range(300).selectExpr("CAST(NULL AS LONG) AS doc_id", "'big' AS source", "10L AS n_tokens")
    assert mixture.mixture(nameless, targets, total=1000)[0].count() == 100


@pytest.mark.parametrize("sign", ["<!-- x ", "\\[ a\n", "*a ", "|a", "<a b ", "[[", "{{", "$a_", "\\emph{", "~~a", "`"])
def test_unclosed_markup_takes_linear_time(sign):
    import time

    text = sign * 20_000
    began = time.process_time()
    markup.tokens(text)
    markup.clean(text)
    assert time.process_time() - began < 20
