import pytest
from pyspark.sql import functions as F

from folioscan.functions import answers as A
from folioscan.functions import rules as R
from folioscan.functions import text as X
from folioscan.operators import chunking


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(column.alias("x")).first().x


SPACES = "　a  b\x0b\x1cc\x85\n"


def test_white_space(spark):
    assert one(spark, X.normalize("t"), t=SPACES) == "a b c"
    assert one(spark, X.normalize("t"), t=None) == ""
    assert one(spark, X.without_space("t"), t=SPACES) == "abc"
    assert one(spark, X.clean_text("t"), t=" 　a \t b\n\n\n\nc ") == "a b\n\nc"
    assert one(spark, X.split_lines("t"), t=" a \r\n\n b c\x0b \x85d") == ["a", "b", "c", "d"]
    assert one(spark, X.split_lines("t"), t=None) == []


@pytest.mark.parametrize("line,marker,generic", [("1-2", True, False), ("XIV", True, False), ("第３页", True, False), ("12", False, False), ("总 则", False, True), ("总则，", False, False), ("第1章", False, False), ("", False, False)])
def test_line_kinds(spark, line, marker, generic):
    assert one(spark, X.is_page_marker(F.col("t")), t=line) is marker
    assert one(spark, X.is_generic_heading(F.col("t")), t=line) is generic


@pytest.mark.parametrize("line,level,title", [
    ("第一百零一条 定义", "article", "第一百零一条 定义"), ("第一章", "chapter", "第一章"), ("第2节　范围", "section", "第2节 范围"), ("一、总则", "part", "一、 总则"),
    ("（三）其他", "item", "（三） 其他"), ("3. 说明", "subitem", "3. 说明"), ("一、", None, None), ("第一千条 x", None, None), ("正文", None, None),
])
def test_headings(spark, line, level, title):
    assert one(spark, X.heading_level(F.col("t")), t=line) == level
    assert one(spark, X.heading_title(F.col("t")), t=line) == title


def test_contents(spark):
    assert one(spark, X.is_toc_line(F.col("t")), t="总则......3") and one(spark, X.is_toc_line(F.col("t")), t="第一章 总则 12")
    assert not one(spark, X.is_toc_line(F.col("t")), t="总则..3")
    assert one(spark, X.toc_title(F.col("t")), t="总则 ...... 3") == "总则" and one(spark, X.toc_target(F.col("t")), t="总则 ...... 3") == 3
    assert one(spark, X.toc_target(F.col("t")), t="总则......99999999999999") is None


def test_tokens(spark):
    assert one(spark, X.tokenize("t"), t="股东大会 ABC 应当 a 保险") == ["股东大会", "股东", "东大", "大会", "股东大", "东大会", "abc", "保险"]
    assert one(spark, X.tokenize("t"), t=None) == []
    assert one(spark, X.unique_terms(F.split("t", ",")), t="b, a ,,b") == ["b", "a"]
    assert one(spark, X.matched_terms(F.col("t"), F.array(F.lit("5 天"), F.lit("无"))), t="期限5\n天") == ["5 天"]


def signals(spark, text, domain=None):
    return one(spark, R.extract_signals(F.col("t"), F.col("d")), t=text, d=domain)


def test_signals(spark):
    s = signals(spark, "第一百零一条与第十条，500万元，2024年起30个工作日，应当报告 strict_v3_009", "regulatory")
    assert s.clauses == ["第十条"] and s.numbers == ["500万", "2024年", "30个工作日"] and s.dates == ["2024年"]
    assert s.codes == ["v3_009"] or "strict_v3_009" in s.codes
    assert "应当" in s.keywords and "报送" in s.keywords
    assert signals(spark, "应当", None).keywords == [] and signals(spark, "应当", "regulatory").keywords == ["应当"]
    assert signals(spark, None, None).keywords == []


def test_keyword_score(spark):
    made = R.extract_signals(F.col("t"), F.col("d"))
    score = lambda text: one(spark, R.keyword_score(X.normalize(F.lit(text)), made, F.col("d")), t="利率 5 %", d="financial_contracts")
    # 利率 1.1, its synonyms 票面利率 and 利息 not contained, number 2.5, domain term 0.3
    assert score("利率为5%") == pytest.approx(1.1 + 2.5 + 0.3)
    assert score("") == 0.0


@pytest.mark.parametrize("raw,fmt,want", [("答案是C和A", "multi", "AC"), ("选B", "mcq", "B"), ("", "tf", ""), (None, "multi", ""), ("because", "mcq", "B"), ("ac", "multi", "AC"), ("DA", None, "D"), ("无", "multi", "")])
def test_answers(spark, raw, fmt, want):
    assert one(spark, A.parse_answer(F.col("r"), F.col("f")), r=raw, f=fmt) == want


def test_think(spark):
    split = lambda t: tuple(one(spark, A.split_think(F.col("t")), t=t))
    assert split("a<think> r </think> b") == ("r", "a b") and split("<think>x") == ("", "<think>x")
    assert split("</think><think>") == ("", "</think><think>") and split(None) == ("", "")


def test_names_and_usage(spark):
    assert one(spark, A.safe_filename(F.col("t")), t="a b/保险.c_") == "a_b_.c" and one(spark, A.safe_filename(F.col("t")), t="保险") == "unknown"
    usage = spark.sql("SELECT named_struct('input_tokens', 3L, 'output_tokens', 4L, 'total_tokens', 0L) u UNION ALL SELECT named_struct('input_tokens', 3L, 'output_tokens', null, 'total_tokens', null) UNION ALL SELECT null")
    got = usage.select(A.total_tokens(F.col("u")), A.logged_total(F.col("u"))).collect()
    assert [tuple(r) for r in got] == [(7, 0), (3, 3), (0, 0)]


def test_prompt(spark):
    row = spark.sql("SELECT 'Q' q, map('A', 'x', 'B', 'y') o, '' e, 'tf' f")
    prompt = row.select(A.build_prompt(F.col("q"), F.col("o"), F.col("e"), F.col("f"))).first()[0]
    assert prompt == "\n\n【题目】\nQ\n\n【选项】\nA. x\nB. y\n\n【要求】\n只输出A或B\n\n答案："


def sequential_split(text, size, overlap):
    parts, start = [], 0
    while True:
        end = min(len(text), start + size)
        if end < len(text):
            cut = max(text.rfind(m, start, end) for m in "。；")
            end = cut + 1 if cut > start + size * 0.5 else end
        parts.append(text[start:end].strip())
        if end >= len(text):
            return [p for p in parts if p]
        start = end - overlap


@pytest.mark.parametrize("text", ["", "短", "甲" * 99 + "。" + "乙" * 500, "甲乙。" * 200, "a b；" * 120 + "c" * 333])
def test_split_long_text(spark, text):
    got = one(spark, chunking.split_long_text(F.col("t"), 140, 12), t=text)
    assert got == (sequential_split(text, 140, 12) if len(text) > 140 else [text] if text else [])
    with pytest.raises(ValueError):
        chunking.split_long_text(F.col("t"), 240, 120)
