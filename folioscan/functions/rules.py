"""Dictionaries and signal extraction for keyword retrieval."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioscan.functions.text import STOPWORDS, TERM_RUN, let, normalize, tokenize, unique_terms

# The terms of each domain, synonyms, and patterns, which must equal the reference behaviour's.
DOMAIN_TERMS = {
    "insurance": [
        "保险责任", "身故保险金", "现金价值", "退保", "领取", "等待期", "免赔额", "赔付", "保单账户", "养老年金", "保险金额", "保险期间", "投保人", "被保险人", "受益人", "豁免",
        "红利", "生存金", "住院", "手术", "重大疾病", "理赔", "续保", "犹豫期",
    ],
    "regulatory": [
        "应当", "不得", "必须", "期限", "处罚", "报告", "备案", "施行", "管理办法", "条例", "股东大会", "董事会", "独立董事", "信息披露", "内幕信息", "违规", "罚款", "警告",
        "吊销", "许可证", "合规", "监管", "证监会", "银保监", "股票代码", "上市公司", "募集资金", "担保",
    ],
    "financial_contracts": [
        "债券", "期限", "利率", "评级", "发行人", "担保", "权利", "义务", "募集", "票面利率", "发行规模", "兑付", "违约", "增信", "质押", "抵押", "承销", "主承销商",
        "信用评级", "到期日", "付息", "回售", "转股", "可转债", "受托管理人", "公司",
    ],
    "financial_reports": [
        "营业收入", "净利润", "现金流", "研发投入", "分红", "年度", "同比", "毛利率", "归母净利润", "扣非净利润", "每股收益", "资产负债率", "总资产", "净资产", "营业成本", "期间费用",
        "存货", "应收账款", "资本开支", "股息", "派息", "净资产收益率", "经营活动",
    ],
    "research": [
        "行业趋势", "公司比较", "增长率", "研究结论", "风险提示", "市场规模", "竞争格局", "渗透率", "市占率", "龙头", "头部", "产能", "出货量", "下游", "上游", "产业链", "估值",
        "目标价", "买入", "推荐", "盈利预测",
    ],
}
SYNONYMS = {
    "身故保险金": ["身故", "死亡保险金", "保险金"],
    "现金价值": ["保单现金价值"],
    "退保": ["解除合同", "退保金", "退还"],
    "营业收入": ["营收", "收入"],
    "净利润": ["归母净利润", "利润"],
    "报告": ["报送", "提交", "报备"],
    "期限": ["时限", "期间", "日内", "个月内"],
    "股东大会": ["股东会", "股东大会审议"],
    "董事会": ["董事会决议", "董事会审议"],
    "信息披露": ["披露", "公告", "公开披露"],
    "研发投入": ["研发费用", "研发支出"],
    "现金流": ["现金流量", "经营现金流"],
    "担保": ["保证", "抵押担保", "质押担保"],
    "利率": ["票面利率", "利息"],
    "评级": ["信用评级", "主体评级", "债项评级"],
}
CLAUSE = r"第[一二三四五六七八九十百千万0-9]+[章节条款项目]"
NUMBER = r"(?U)\d+(?:\.\d+)?\s*(?:万|万元|亿|亿元|%|％|个工作日|个自然日|日|天|年|个月|月)"
DATE = r"(?U)(?:19|20)\d{2}\s*年?"
CODE = r"(?U)[A-Za-z_]+[_-]?\d{2,}|csrc_\d{4}|strict_v\d+_\d+"

SIGNALS = ("keywords", "clauses", "numbers", "dates", "codes")
#: What a contained term of each kind adds to the keyword score; keywords add 0.05 for each of up to 8 characters besides.
WEIGHTS = {"keywords": 1.0, "clauses": 3.0, "numbers": 2.5, "dates": 1.5, "codes": 2.0}
DOMAIN_WEIGHT = 0.3


def _array(words: list[str]) -> Column:
    """A constant array; as one expression, since building it word by word costs a call each."""
    return F.expr(f"array({', '.join(repr(w) for w in words)})" if words else "cast(array() AS array<string>)")


def domain_terms(domain: Column) -> Column:
    """All terms of a domain; none for an unknown or null one."""
    chosen = F.lit(None).cast("array<string>")
    for name, words in DOMAIN_TERMS.items():
        chosen = F.when(domain == name, _array(words)).otherwise(chosen)
    return F.coalesce(chosen, _array([]))


def with_synonyms(term: Column) -> Column:
    """The term and its synonyms, which are not expanded again."""
    table = F.expr("map(" + ", ".join(f"{head!r}, array({', '.join(map(repr, words))})" for head, words in SYNONYMS.items()) + ")")
    return F.concat(F.array(term), F.coalesce(F.try_element_at(table, term), _array([])))


def extract_signals(text: Column, domain: Column) -> Column:
    """struct of keywords, clauses, numbers, dates and codes, each in order of first occurrence.

    Keywords are the runs of terms that are no stop words, then the domain's terms that the text contains, each
    followed by its synonyms.
    """

    def signals(plain: Column) -> Column:
        runs = F.filter(F.regexp_extract_all(plain, F.lit(TERM_RUN), F.lit(0)), lambda t: ~F.array_contains(_array(STOPWORDS), t))
        known = F.filter(domain_terms(domain), lambda t: F.contains(plain, t))
        found = lambda pattern: unique_terms(F.regexp_extract_all(plain, F.lit(pattern), F.lit(0)))
        return F.struct(
            unique_terms(F.flatten(F.transform(F.concat(runs, known), with_synonyms))).alias("keywords"),
            found(CLAUSE).alias("clauses"), found(NUMBER).alias("numbers"), found(DATE).alias("dates"), found(CODE).alias("codes"),
        )

    return let(normalize(text), signals)


def all_terms(signals: Column) -> Column:
    """All signals as one list, each term at its first place."""
    return F.array_distinct(F.concat(*(signals[s] for s in SIGNALS)))


def query_terms(text: Column, domain: Column) -> Column:
    """signals and index tokens of a text as one list."""
    return unique_terms(F.concat(all_terms(extract_signals(text, domain)), tokenize(text)))


def question_query(question: Column, options: Column) -> Column:
    """question and option texts (a map, in its order), normalized; empty parts are skipped."""
    parts = F.concat(F.array(question), F.coalesce(F.map_values(options), _array([])))
    return F.array_join(F.transform(F.filter(parts, lambda p: p.isNotNull() & (p != "")), normalize), " ")


def keyword_score(text: Column, signals: Column, domain: Column) -> Column:
    """Weighted number of contained terms; text must be normalized, an empty one scores 0.

    Numbers are compared without spaces, all else as it stands, with case.
    """
    count = lambda terms, inside: F.size(F.filter(terms, inside)).cast("double")
    words = F.aggregate(
        F.filter(signals["keywords"], lambda t: F.contains(text, t)), F.lit(0.0),
        lambda sum_, t: sum_ + F.lit(WEIGHTS["keywords"]) + F.least(F.length(t), F.lit(8)) * F.lit(0.05),
    )
    score = (
        words
        + count(signals["clauses"], lambda t: F.contains(text, t)) * WEIGHTS["clauses"]
        + let(
            F.replace(text, F.lit(" "), F.lit("")),
            lambda bare: count(signals["numbers"], lambda t: F.contains(bare, F.replace(t, F.lit(" "), F.lit("")))),
        ) * WEIGHTS["numbers"]
        + count(signals["dates"], lambda t: F.contains(text, t)) * WEIGHTS["dates"]
        + count(signals["codes"], lambda t: F.contains(text, t)) * WEIGHTS["codes"]
        + count(domain_terms(domain), lambda t: F.contains(text, t)) * DOMAIN_WEIGHT
    )
    return F.when(text == "", F.lit(0.0)).otherwise(score)
