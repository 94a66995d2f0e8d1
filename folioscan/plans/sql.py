"""DuckDB SQL of the core queries: named parts that are put together as needed."""

from __future__ import annotations

from folioscan.functions import rules as R

# Patterns in RE2's syntax, written for these statements.
WS = r"[\s\p{Z}\x0b\x1c-\x1f\x85]+"
WS0 = WS[:-1] + "*"
RUN = r"[\x{4e00}-\x{9fff}A-Za-z0-9%％]{2,}"
ORDINAL = "第[一二三四五六七八九十百零〇0-9]+"
HAN_NUMBER = "[一二三四五六七八九十]"
HEADING_PATTERNS = {
    "chapter": f"^({ORDINAL}章){WS0}(.+)?$", "section": f"^({ORDINAL}节){WS0}(.+)?$", "article": f"^({ORDINAL}条){WS0}(.+)?$",
    "part": f"^({HAN_NUMBER}+、){WS0}(.+)$", "item": f"^(（{HAN_NUMBER}+）){WS0}(.+)$", "subitem": rf"^(\p{{Nd}}+[、.]){WS0}(.+)$",
}
MARKER = r"^(?:\p{Nd}+(?:-\p{Nd}+)+|[IVXLCivxlc]+|第?\p{Nd}+页)$"
GENERIC = r"^[\x{4e00}-\x{9fff}A-Za-z（）()“”‘’《》\-]+$"
DOTS = "[.。…]{3,}"
NUMBERED = rf"(?:{ORDINAL}[章节条]|{HAN_NUMBER}+、).+\p{{Nd}}+$"
ENTRY = r"(.+?)[.。…\s\p{Z}]+(\p{Nd}+)$"
CLAUSE = "第[一二三四五六七八九十百千万0-9]+[章节条款项目]"
NUMBER = rf"\p{{Nd}}+(?:\.\p{{Nd}}+)?{WS0}(?:万|万元|亿|亿元|%|％|个工作日|个自然日|日|天|年|个月|月)"
DATE = rf"(?:19|20)\p{{Nd}}{{2}}{WS0}年?"
CODE = r"[A-Za-z_]+[_-]?\p{Nd}{2,}|csrc_\p{Nd}{4}|strict_v\p{Nd}+_\p{Nd}+"
STOP = ["关于", "以下", "下列", "正确", "错误", "的是", "根据", "结合", "假设", "分别", "需要", "应当", "进行", "其中"]
BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}]"


def quoted(word: str) -> str:
    return "'" + word.replace("'", "''") + "'"


def words(items) -> str:
    return "[" + ", ".join(map(quoted, items)) + "]"


def norm(x: str) -> str:
    return f"trim(regexp_replace(coalesce({x}, ''), '{WS}', ' ', 'g'))"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}|{WS}$', '', 'g')"


def bare(x: str) -> str:
    return f"regexp_replace(coalesce({x}, ''), '{WS}', '', 'g')"


def compact(x: str) -> str:
    return f"replace({norm(x)}, ' ', '')"


def lines(x: str) -> str:
    return f"list_filter(list_transform(string_split_regex(coalesce({x}, ''), '{BREAK}'), lambda l: {strip('l')}), lambda l: l <> '')"


def tokens(x: str) -> str:
    grams = (
        "CASE WHEN regexp_matches(r, '[\\x{4e00}-\\x{9fff}]') AND length(r) > 2 THEN "
        "list_concat(list_concat([r], list_transform(range(1, length(r)), lambda i: substring(r, i, 2))), list_transform(range(1, length(r) - 1), lambda i: substring(r, i, 3))) "
        "ELSE [r] END"
    )
    runs = f"regexp_extract_all(lower({norm(x)}), '{RUN}')"
    return f"list_filter(flatten(list_transform({runs}, lambda r: {grams})), lambda t: NOT list_contains({words(STOP)}, t))"


def ordered_unique(x: str) -> str:
    """Distinct items of a list of normalized strings at their first places, without empty ones."""
    return f"list_filter({x}, lambda t, i: t <> '' AND list_position({x}, t) = i)"


def domain_terms(d: str) -> str:
    return "CASE " + " ".join(f"WHEN {d} = {quoted(n)} THEN {words(w)}" for n, w in R.DOMAIN_TERMS.items()) + " ELSE []::VARCHAR[] END"


SYNONYM_CASE = "CASE t " + " ".join(f"WHEN {quoted(h)} THEN {words([h, *w])}" for h, w in R.SYNONYMS.items()) + " ELSE [t] END"


def is_marker(x: str) -> str:
    return f"regexp_matches({bare(x)}, '{MARKER}')"


def is_generic(x: str) -> str:
    b = bare(x)
    return f"(length({b}) BETWEEN 1 AND 20 AND NOT {is_marker(x)} AND NOT regexp_matches({b}, '[，。；：,.!?\\p{{Nd}}]') AND regexp_matches({b}, '{GENERIC}'))"


def is_toc(x: str) -> str:
    b = bare(x)
    return f"((regexp_matches({x}, '{DOTS}') AND regexp_matches({b}, '\\p{{Nd}}+$')) OR regexp_matches({b}, '{NUMBERED}'))"


def level(x: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({x}, '{p}') THEN '{n}'" for n, p in HEADING_PATTERNS.items()) + " END"


def title(x: str) -> str:
    cases = (
        f"WHEN regexp_matches({x}, '{p}') THEN {strip(f'''{strip(f'''regexp_extract({x}, '{p}', 1)''')} || ' ' || {strip(f'''coalesce(regexp_extract({x}, '{p}', 2), '')''')}''')}"
        for p in HEADING_PATTERNS.values()
    )
    return "CASE " + " ".join(cases) + " END"


def toc_page(l: str) -> str:
    return f"(list_contains({l}[1:5], '目录') OR len(list_filter({l}, lambda x: {is_toc('x')})) >= 5)"


def signals(text: str, domain: str) -> str:
    """A struct of five lists over a normalized text column."""
    runs = f"list_filter(regexp_extract_all({text}, '{RUN}'), lambda t: NOT list_contains({words(STOP)}, t))"
    known = f"list_filter({domain_terms(domain)}, lambda t: contains({text}, t))"
    return f"flatten(list_transform(list_concat({runs}, {known}), lambda t: {SYNONYM_CASE}))"


def found(text: str, pattern: str) -> str:
    return f"list_transform(regexp_extract_all({text}, '{pattern}'), lambda t: {norm('t')})"


def keyword_score(t: str, s: str, d: str) -> str:
    has = lambda name: f"len(list_filter({s}.{name}, lambda t: contains({t}, t)))"
    return (
        f"CASE WHEN {t} = '' THEN 0.0 ELSE list_sum(list_concat([0.0::DOUBLE], list_transform(list_filter({s}.keywords, lambda t: contains({t}, t)), lambda t: 1.0 + least(length(t), 8) * 0.05::DOUBLE)))"
        f" + {has('clauses')} * 3.0::DOUBLE + len(list_filter({s}.numbers, lambda t: contains(replace({t}, ' ', ''), replace(t, ' ', '')))) * 2.5::DOUBLE"
        f" + {has('dates')} * 1.5::DOUBLE + {has('codes')} * 2.0::DOUBLE + len(list_filter({domain_terms(d)}, lambda t: contains({t}, t))) * 0.3::DOUBLE END"
    )


def matched(t: str, terms: str) -> str:
    return f"list_filter({terms}, lambda t: {compact('t')} <> '' AND contains({compact(t)}, {compact('t')}))[1:20]"


NO_DOMAIN = "CASE WHEN q.domain = '' THEN TRUE ELSE c.domain = '' OR c.domain = q.domain END"
K_OF_PLACE = "CASE WHEN place = 0 THEN 30 ELSE 15 END"

#: name -> (names it uses, body)
PARTS: dict[str, tuple[str, str]] = {
    "idx": ("", "SELECT doc_id, arg_max(domain, (indexed_at, domain)) FILTER (domain IS NOT NULL) AS domain, arg_max(title, (indexed_at, title)) FILTER (title IS NOT NULL) AS title, arg_max(source_markdown_path, (indexed_at, source_markdown_path)) FILTER (source_markdown_path IS NOT NULL) AS source_path FROM document_index GROUP BY doc_id"),
    "one": ("", "SELECT DISTINCT ON (chunk_id) * FROM chunks"),
    "ch": ("one idx", f"SELECT ord, chunk_id, o.doc_id, regexp_replace(trim(lower(coalesce(nullif(o.domain, ''), nullif(i.domain, ''), ''))), ' +', '_', 'g') AS domain, {norm("coalesce(nullif(retrieval_text, ''), nullif(text, ''))")} AS text, text AS original_text, source_path FROM one o LEFT JOIN idx i ON o.doc_id = i.doc_id WHERE {norm("coalesce(nullif(retrieval_text, ''), nullif(text, ''))")} <> ''"),
    "qs": ("", "SELECT DISTINCT ON (qid) qid, coalesce(domain, '') AS domain, split, question, options, answer_format, type, doc_ids FROM questions WHERE qid IS NOT NULL"),
    "tok": ("ch", f"SELECT ord, chunk_id, doc_id, domain, {tokens('text')} AS toks FROM ch"),
    "dl": ("tok", "SELECT ord, chunk_id, doc_id, domain, len(toks) AS dl FROM tok"),
    "corpus": ("dl", "SELECT count(*) AS n, coalesce(avg(dl), 0.0) AS avgdl FROM dl"),
    "tf": ("tok", "SELECT ord, term, count(*) AS tf FROM (SELECT ord, unnest(toks) AS term FROM tok) GROUP BY ord, term"),
    "df": ("tf corpus", "SELECT term, count(*) AS df, ln(1 + (any_value(n) - count(*) + 0.5::DOUBLE) / (count(*) + 0.5::DOUBLE)) AS idf FROM tf, corpus GROUP BY term"),
    "qq": ("qs", f"""
        SELECT qid, domain, 0 AS place, NULL::VARCHAR AS option, array_to_string(list_transform(list_filter(list_concat([question], coalesce(map_values(options), [])), lambda p: p IS NOT NULL AND p <> ''), lambda p: {norm('p')}), ' ') AS text, doc_ids FROM qs
        UNION ALL SELECT qid, domain, generate_subscripts(map_entries(options), 1) AS place, unnest(map_entries(options)).key AS option, {norm('question')} || ' ' || {norm('unnest(map_entries(options)).value')} AS text, doc_ids FROM qs"""),
    "qn": ("qq", f"SELECT *, {norm('text')} AS plain FROM qq"),
    "qr": ("qn", f"SELECT *, list_transform({signals('plain', 'domain')}, lambda t: {norm('t')}) AS kw, {found('plain', CLAUSE)} AS cl, {found('plain', NUMBER)} AS nu, {found('plain', DATE)} AS da, {found('plain', CODE)} AS co FROM qn"),
    "sig": ("qr", f"SELECT qid, domain, place, option, text, doc_ids, struct_pack(keywords := {ordered_unique('kw')}, clauses := {ordered_unique('cl')}, numbers := {ordered_unique('nu')}, dates := {ordered_unique('da')}, codes := {ordered_unique('co')}) AS s FROM qr"),
    "docs": ("ch", "SELECT doc_id, min(ord) AS ord, coalesce(arg_max(domain, ord) FILTER (domain <> ''), '') AS domain, ' ' || string_agg(substring(text, 1, 800), ' ' ORDER BY ord) AS text FROM ch GROUP BY doc_id"),
    "docn": ("docs", f"SELECT doc_id, ord, domain, {norm('text')} AS text FROM docs"),
    "recall_scored": ("sig docn", f"SELECT qid, doc_id, ord, c.domain, round({keyword_score('c.text', 'q.s', 'q.domain')} + CASE WHEN doc_id <> '' AND contains(q.text, doc_id) THEN 5.0 ELSE 0.0 END, 6) AS score FROM sig q JOIN docn c ON {NO_DOMAIN} WHERE q.place = 0 AND coalesce(len(q.doc_ids), 0) = 0"),
    "recall": ("recall_scored", "SELECT qid, doc_id, domain, score, row_number() OVER (PARTITION BY qid ORDER BY score DESC, ord) AS rank FROM recall_scored WHERE score > 0 QUALIFY rank <= 8"),
    "cand": ("qs recall", "SELECT DISTINCT qid, unnest(doc_ids) AS doc_id FROM qs WHERE coalesce(len(doc_ids), 0) > 0 UNION ALL SELECT qid, doc_id FROM recall"),
    "free": ("qs cand", "SELECT qid FROM qs WHERE qid NOT IN (SELECT qid FROM cand WHERE doc_id IS NOT NULL)"),
    "qt": ("qq", f"SELECT qid, place, domain, term, count(*) AS qtf FROM (SELECT qid, place, domain, unnest({tokens('text')}) AS term FROM qq) GROUP BY ALL"),
    "allowed": ("qs cand free ch", "SELECT c.qid, h.ord FROM cand c JOIN ch h ON h.doc_id = c.doc_id UNION ALL SELECT f.qid, h.ord FROM free f, ch h"),
    "lex": ("qt tf df dl corpus allowed", f"SELECT q.qid, q.place, c.ord, c.chunk_id, c.doc_id, c.domain, round(sum(q.qtf * idf * tf * 2.5::DOUBLE / (tf + 1.5::DOUBLE * (1 - 0.75::DOUBLE + 0.75::DOUBLE * dl / avgdl))), 6) AS score FROM qt q JOIN tf USING (term) JOIN df USING (term) JOIN dl c ON c.ord = tf.ord JOIN allowed a ON a.qid = q.qid AND a.ord = c.ord, corpus WHERE {NO_DOMAIN} GROUP BY ALL"),
    "lexhits": ("lex", f"SELECT *, row_number() OVER (PARTITION BY qid, place ORDER BY score DESC, ord) AS rank FROM lex WHERE score > 0 QUALIFY rank <= {K_OF_PLACE}"),
    "kw": ("sig ch allowed", f"SELECT q.qid, q.place, c.ord, c.chunk_id, c.doc_id, round({keyword_score('c.text', 'q.s', 'q.domain')}, 6) AS score FROM sig q JOIN allowed a ON a.qid = q.qid JOIN ch c ON c.ord = a.ord WHERE {NO_DOMAIN}"),
    "kwhits": ("kw", f"SELECT *, row_number() OVER (PARTITION BY qid, place ORDER BY score DESC, ord) AS rank FROM kw WHERE score > 0 QUALIFY rank <= {K_OF_PLACE}"),
    "hits": ("lexhits kwhits sig ch", f"""
        SELECT h.qid, h.ord, c.chunk_id, c.doc_id, c.domain, c.text, c.original_text, q.option, h.search, h.place * 1000000 + h.search * 1000 + h.rank AS pos,
            round(h.score * CASE WHEN h.search = 1 THEN 1.2::DOUBLE ELSE 1.0::DOUBLE END + least(len({matched('c.text', 'q.s.clauses')}), 3) * 3.0::DOUBLE + least(len({matched('c.text', 'q.s.numbers')}), 5) * 2.0::DOUBLE + least(len({matched('c.text', 'q.s.dates')}), 3) * 1.0::DOUBLE, 6) AS score,
            q.s AS s
        FROM (SELECT qid, place, ord, score, rank, 0 AS search FROM lexhits UNION ALL SELECT qid, place, ord, score, rank, 1 FROM kwhits) h JOIN sig q ON q.qid = h.qid AND q.place = h.place JOIN ch c ON c.ord = h.ord"""),
    "best": ("hits", "SELECT *, min(pos) OVER (PARTITION BY qid, ord) AS first_at FROM hits QUALIFY row_number() OVER (PARTITION BY qid, ord ORDER BY score DESC, pos) = 1"),
    "uniq": ("best", "SELECT * FROM best QUALIFY row_number() OVER (PARTITION BY qid, substring(text, 1, 120) ORDER BY score DESC, first_at) = 1"),
    "pages": ("one", f"SELECT doc_id, chunk_index AS page, text, {lines('text')} AS l FROM one"),
    "spans": ("pages", "SELECT doc_id, count(*) AS n_pages, min(page) AS first_page FROM pages GROUP BY doc_id"),
    "edges": ("pages spans", """
        SELECT doc_id, edge, line, count(*) AS n FROM (
            SELECT p.doc_id, 'header' AS edge, unnest(l[1:3]) AS line FROM pages p JOIN spans s ON s.doc_id = p.doc_id WHERE n_pages >= 3 AND page <> first_page
            UNION ALL SELECT p.doc_id, 'footer', unnest(l[greatest(len(l) - 2, 1):]) FROM pages p JOIN spans s ON s.doc_id = p.doc_id WHERE n_pages >= 3 AND page <> first_page)
        WHERE length(line) >= 6 GROUP BY ALL"""),
    "repeated": ("edges spans", "SELECT e.doc_id, edge, line, n FROM edges e JOIN spans s ON s.doc_id = e.doc_id WHERE n >= greatest(2, n_pages // 3)"),
    "numbered": ("pages", f"SELECT doc_id, page, unnest(l) AS line, generate_subscripts(l, 1) AS i FROM pages"),
    "strippable": ("numbered repeated", f"SELECT n.doc_id, page, i, n.line, {is_marker('n.line')} OR h.line IS NOT NULL AS top, {is_marker('n.line')} OR f.line IS NOT NULL AS foot FROM numbered n LEFT JOIN repeated h ON h.doc_id = n.doc_id AND h.line = n.line AND h.edge = 'header' LEFT JOIN repeated f ON f.doc_id = n.doc_id AND f.line = n.line AND f.edge = 'footer'"),
    "limits": ("strippable", "SELECT doc_id, page, min(i) FILTER (NOT top) AS a, max(i) FILTER (NOT foot) AS b FROM strippable GROUP BY ALL"),
    "stripped": ("pages limits", f"SELECT p.doc_id, p.page, {strip("array_to_string(CASE WHEN a IS NULL OR b IS NULL OR b < a THEN []::VARCHAR[] ELSE l[a:b] END, chr(10))")} AS text FROM pages p LEFT JOIN limits m ON m.doc_id = p.doc_id AND m.page = p.page"),
    "sl": ("stripped", f"SELECT doc_id, page, text, {lines('text')} AS l FROM stripped"),
    "typed": ("sl", f"SELECT doc_id, page, l, CASE WHEN length({bare('text')}) < 2 THEN 'empty' WHEN {toc_page('l')} THEN 'toc' ELSE 'content' END AS page_type FROM sl"),
    "ln": ("typed", "SELECT doc_id, page, unnest(l) AS line, generate_subscripts(l, 1) AS i FROM typed WHERE page_type = 'content'"),
    "lv": ("ln", f"SELECT doc_id, page, i, line, coalesce({level('line')}, CASE WHEN i = 1 AND {is_generic('line')} THEN 'heading' END) AS level, coalesce({title('line')}, CASE WHEN i = 1 AND {is_generic('line')} THEN line END) AS own_title FROM ln"),
    "sg": ("lv", "SELECT *, sum(CASE WHEN i = 1 OR (level IS NOT NULL AND level <> 'heading') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, page ORDER BY i) - 1 AS segment FROM lv"),
    "starts": ("sg", f"SELECT doc_id, page, segment, arg_min(level, i) FILTER (TRUE) AS x, any_value(level) FILTER (first) AS level, any_value(own_title) FILTER (first) AS own_title, {strip("string_agg(line, chr(10) ORDER BY i)")} AS text FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, page, segment ORDER BY i) = 1 AS first FROM sg) GROUP BY doc_id, page, segment"),
    "placed": ("starts", "SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY page, segment) AS place FROM starts"),
    "state": ("placed", "SELECT *, " + ", ".join(f"max(CASE WHEN level = '{n}' THEN place END) OVER w AS p_{n}, last_value(CASE WHEN level = '{n}' THEN own_title END IGNORE NULLS) OVER w AS t_{n}" for n in ("heading", "chapter", "section", "article", "part", "item", "subitem")) + " FROM placed WINDOW w AS (PARTITION BY doc_id ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"),
    "tr": ("", "SELECT DISTINCT ON (trace_id) * FROM traces"),
    "parsed": ("tr qs", """
        SELECT trace_id, t.qid, logged_at, q.domain AS domain, split, CASE WHEN answer_format = 'multi' THEN array_to_string(list_sort(list_distinct(regexp_extract_all(upper(coalesce(answer, '')), '[A-D]'))), '') ELSE coalesce(regexp_extract_all(upper(coalesce(answer, '')), '[A-D]')[1], '') END AS answer,
            coalesce(usage.input_tokens, 0) AS prompt_tokens, coalesce(usage.output_tokens, 0) AS completion_tokens,
            CASE WHEN coalesce(usage.total_tokens, 0) <> 0 THEN usage.total_tokens ELSE coalesce(usage.input_tokens, 0) + coalesce(usage.output_tokens, 0) END AS total_tokens
        FROM tr t JOIN qs q ON q.qid = t.qid"""),
    "verdict": ("parsed", """
        SELECT g.qid, g.domain, g.split, g.gold, a.answer, a.total_tokens, CASE WHEN g.gold <> '' AND a.answer = g.gold THEN 1 ELSE 0 END AS correct
        FROM (SELECT qid, any_value(domain) AS domain, any_value(split) AS split, arg_min(answer, (logged_at, trace_id)) AS gold FROM parsed GROUP BY qid) g
        JOIN (SELECT qid, arg_max(answer, (logged_at, trace_id)) AS answer, CAST(sum(total_tokens) AS BIGINT) AS total_tokens FROM parsed GROUP BY qid) a ON a.qid = g.qid"""),
}


def cleaned(x: str) -> str:
    return strip(f"regexp_replace(regexp_replace(translate(coalesce({x}, ''), chr(12288) || chr(160), '  '), '[ \\t]+', ' ', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g')")


def build(names: str, body: str, instead: dict[str, tuple[str, str]] | None = None, recursive: bool = False) -> str:
    """A statement of the parts it needs, in order, and a body; `instead` holds parts that take the place of others."""
    parts = PARTS | (instead or {})
    done: list[str] = []

    def add(name: str) -> None:
        if name not in done:
            for x in parts[name][0].split():
                add(x)
            done.append(name)

    for name in names.split():
        add(name)
    head = ", ".join(f"{n} AS MATERIALIZED ({parts[n][1]})" for n in done)
    return f"WITH {'RECURSIVE ' if recursive else ''}{head} {body}" if head else body


#: The pages of raw files: texts as one page, and volumes of chunks as PDF.
RAW_PAGES = {
    "rawpages": ("one", f"SELECT 'doc_' || doc_id AS doc_id, 1 AS page, 'txt' AS kind, {cleaned('text')} AS text FROM documents UNION ALL SELECT md5(doc_id || '-' || (chunk_index // 50)), CAST(row_number() OVER (PARTITION BY doc_id, chunk_index // 50 ORDER BY chunk_index) AS INTEGER), 'pdf', {cleaned('text')} FROM one"),
    "pages": ("rawpages", f"SELECT doc_id, page, text, {lines('text')} AS l FROM rawpages"),
}
#: Pages of contents and pages with edges, made of chunks.
CONTENTS_PAGES = {
    "pages": ("one", f"""SELECT doc_id, page, text, {lines('text')} AS l FROM (SELECT doc_id, chunk_index AS page, '目录' || chr(10) || coalesce(section_title, '无题') || '......' || chunk_index || chr(10) || '第一章 ' || coalesce(section_title, '无题') || ' … ' || (chunk_index + 7) || chr(10) || '附录 … ' || chunk_index AS text FROM one)"""),
}
EDGED_PAGES = {
    "pages": ("one", f"""SELECT doc_id, page, text, {lines('text')} AS l FROM (SELECT doc_id, chunk_index AS page, '年度报告 ' || doc_id || chr(10) || chunk_index || '-' || (chunk_index + 1) || chr(10) || coalesce(text, '') || chr(10) || '内部资料请勿外传 ' || (chunk_index % 2) AS text FROM one)"""),
}
