import json
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from folioscan.functions import rules
from folioscan.operators import chunking, evaluate, recall, retrieve, scoring, structure
from folioscan.operators.bm25 import Bm25Index
from folioscan.sources import files, json_tables, sinks
from folioscan.streaming.traces import run_token_windows, token_windows

CHUNK = "ord long, chunk_id string, doc_id string, domain string, text string, original_text string"


def chunk_table(spark, rows):
    return spark.createDataFrame([(*r, r[-1]) for r in rows], CHUNK)


def pages(spark, texts, doc="d"):
    return spark.createDataFrame([(doc, i, t) for i, t in enumerate(texts, 1)], "doc_id string, page int, text string")


def test_edges(spark):
    head, foot = "某某公司年度报告", "机密文件请勿外传"
    df = pages(spark, [f"{head}\n封面", f"{head}\n1-2\n甲\n12\n{foot}", f"{head}\n乙\nXIV\n{foot}", f"{head}\n{foot}"])
    assert {(r.edge, r.line, r.n) for r in structure.repeated_edge_lines(df).collect()} == {("header", head, 3), ("footer", foot, 3)}
    got = {r.page: r.text for r in structure.strip_page_edges(df).collect()}
    assert got[2].startswith("甲\n12") and got[3] == "乙" and got[4] == ""
    assert structure.repeated_edge_lines(pages(spark, ["x" * 9] * 2)).count() == 0


def sequential_segments(texts):
    """A plain model of heading state over pages of lines that are marked (level, title, line)."""
    below = {"chapter": ("section", "article", "part", "item", "subitem"), "section": ("article", "part", "item", "subitem"), "article": ("part", "item", "subitem"), "part": ("item", "subitem"), "item": ("subitem",), "subitem": (), "heading": ()}
    state, out = {}, []
    for page, lines in enumerate(texts, 1):
        segment = -1
        for i, (level, title, line) in enumerate(lines):
            if level:
                state[level] = title
                for x in below[level]:
                    state.pop(x, None)
            if level or i == 0:
                segment += 1
                deepest = next((state[n] for n in reversed(structure.LEVELS) if n in state), "")
                out.append([page, segment, title or deepest, dict(state), [line]])
            else:
                out[-1][4].append(line)
    return [(p, s, t, st, "\n".join(ls)) for p, s, t, st, ls in out]


def test_hierarchy_equals_sequential_model(spark):
    rng = random.Random(4)
    kinds = [("chapter", "第{}章", ""), ("section", "第{}节", ""), ("article", "第{}条", ""), ("part", "{}、", "名"), ("item", "（{}）", "目"), ("subitem", "{}.", "点"), (None, None, None)]
    marked, texts = [], []
    for p in range(25):
        lines = []
        for i in range(rng.randint(1, 9)):
            level, form, tail = rng.choice(kinds)
            n = rng.choice("一二三四五") if level != "subitem" else str(rng.randint(1, 9))
            if level:
                head = form.format(n)
                lines.append((level, f"{head} {tail}".strip(), f"{head}{tail}"))
            elif i == 0 and rng.random() < 0.5:
                lines.append(("heading", f"题{n}", f"题{n}"))
            else:
                lines.append((None, None, f"正文，第{p}页。"))
        marked.append(lines)
        texts.append("\n".join(x[2] for x in lines))
    got = [(r.page, r.segment, r.title, {n: r[f"h_{n}"] for n in structure.LEVELS if r[f"h_{n}"] is not None}, r.text) for r in structure.segments(pages(spark, texts)).orderBy("page", "segment").collect()]
    assert got == sequential_segments(marked)


def test_hierarchy_of_a_document_in_many_ranges(spark):
    """State is handed from range to range, also over ranges without headings; documents do not mix."""
    rng = random.Random(5)
    rows, want = [], {}
    below = {n: structure.LEVELS[i + 1 :] for i, n in enumerate(structure.LEVELS)} | {"heading": ()}
    for doc, pages_ in (("a", 120), ("b", 3), ("c", 40)):
        state = {}
        for page in range(pages_):
            for segment in range(rng.randint(1, 3)):
                level = rng.choice([*structure.LEVELS, None, None]) if page % 50 < 10 else None
                title = f"{doc}{page}.{segment}" if level else None
                if level:
                    state[level] = title
                    for x in below[level]:
                        state.pop(x, None)
                rows.append((doc, page, segment, level, title))
                want[doc, page, segment] = (title or next((state[n] for n in reversed(structure.LEVELS) if n in state), ""), dict(state))
    df = spark.createDataFrame(rows, "doc_id string, page int, segment int, level string, own_title string").repartition(6)
    got = {(r.doc_id, r.page, r.segment): (r.title, {n: r[f"h_{n}"] for n in structure.LEVELS if r[f"h_{n}"] is not None}) for r in structure.heading_state(df).collect()}
    assert got == want


def test_page_types(spark):
    df = pages(spark, ["目录\n第一章 总则", "x", "正文内容", "\n".join(f"第{n}章 甲 {i}" for i, n in enumerate("一二三四五"))])
    assert [r.page_type for r in structure.page_types(df).orderBy("page").collect()] == ["toc", "empty", "content", "toc"]
    assert structure.segments(df).select("page").distinct().count() == 1


def test_chunks_from_segments(spark):
    segs = structure.segments(pages(spark, ["第一章 总则\n" + "甲乙丙。" * 500]))
    rows = chunking.chunks_from_segments(segs, F.lit("x")).orderBy("part").collect()
    assert rows[0].chunk_id == "d:p1:s0:c0" and rows[0].text.startswith("第一章 总则 第一章 总则 第一章 总则 第一章 总则 甲乙丙") and len(rows) > 1


def brute_bm25(texts, query, tok):
    docs = [Counter(tok(t)) for t in texts]
    n, avg = len(docs), sum(map(sum, (d.values() for d in docs))) / len(docs)
    df = Counter(t for d in docs for t in d)
    out = []
    for d in docs:
        dl = sum(d.values())
        out.append(round(sum(math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * d[t] * 2.5 / (d[t] + 1.5 * (0.25 + 0.75 * dl / avg)) for t in tok(query) if d[t]), 6))
    return out


def test_bm25(spark, tmp_path):
    texts = ["aa bb bb", "aa cc", "dd", "aa bb cc dd", "。"]
    rows = chunk_table(spark, [(i, f"c{i}", f"d{i % 2}", "x" if i else "", t) for i, t in enumerate(texts)])
    index = Bm25Index.build(rows)
    asked = spark.createDataFrame([("q", "bb aa bb", "x", 2), ("none", "zz", "", 2)], "query string, text string, domain string, k int")
    want = brute_bm25(texts, "bb aa bb", lambda t: t.replace("。", "").split())
    got = {r.ord: r.score for r in index.search(asked, top_k=10).collect()}
    assert got == pytest.approx({i: s for i, s in enumerate(want) if s > 0})
    restricted = index.search(asked, spark.createDataFrame([("q", "d1")], "query string, doc_id string"), "k").collect()
    assert {r.ord for r in restricted} == {1, 3} and {r.ord: r.score for r in restricted} == pytest.approx({i: want[i] for i in (1, 3)})
    index.save(str(tmp_path / "ix"))
    again = Bm25Index.load(spark, str(tmp_path / "ix")).search(asked, top_k=10)
    assert {r.ord: r.score for r in again.collect()} == pytest.approx(got)
    empty = Bm25Index.build(rows.limit(0))
    assert empty.search(asked).count() == 0 and empty.corpus.first().avgdl == 0.0


def test_search_uses_the_tokenizer_of_its_index(spark, tmp_path):
    letters = lambda c: F.split(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")), "")
    rows = chunk_table(spark, [(0, "c0", "d", "", "ab"), (1, "c1", "d", "", "bc")])
    index = Bm25Index.build(rows, letters)
    asked = spark.createDataFrame([("q", "cz", "")], "query string, text string, domain string")
    assert [r.ord for r in index.search(asked).collect()] == [1] == [r.ord for r in index.kept().search(asked).collect()]
    index.save(str(tmp_path / "ix"))
    assert [r.ord for r in Bm25Index.load(spark, str(tmp_path / "ix"), tokenizer=letters).search(asked).collect()] == [1]


@pytest.mark.parametrize("size", [1, 3, 1000])
def test_match_terms_in_blocks(spark, monkeypatch, size):
    monkeypatch.setattr(scoring, "BLOCK_CHARS", size)
    pieces = spark.createDataFrame([("a", 1, "利率为5 %"), ("a", 2, None), ("b", 3, "到期日"), ("c", 4, "")], "doc_id string, ord long, text string")
    terms = scoring.numbered_terms(spark.createDataFrame([("plain", "利率"), ("bare", "5%"), ("plain", "5%"), ("plain", "期"), ("plain", ""), ("plain", "率为"), ("plain", None)], "kind string, term string"))
    of = {r.term_id: (r.kind, r.term) for r in terms.collect()}
    assert len(of) == 5
    got = {(r.ord, of[t]) for r in scoring.match_terms(pieces, terms).collect() for t in r.terms}
    assert got == {(1, ("plain", "利率")), (1, ("bare", "5%")), (3, ("plain", "期")), (1, ("plain", "率为"))}
    joined = {(r.doc_id, of[t]) for r in scoring.match_joined(pieces, terms).collect() for t in r.terms}
    assert joined == {("a", x) for x in (("plain", "利率"), ("bare", "5%"), ("plain", "率为"))} | {("b", ("plain", "期"))}


@pytest.mark.parametrize("size", [9, 10_000])
def test_terms_that_reach_over_many_texts_are_found(spark, monkeypatch, size):
    """Terms of all lengths against the joined text, with ranges that end within documents."""
    monkeypatch.setattr(scoring, "BLOCK_CHARS", size)
    rng = random.Random(6)
    docs = {f"d{k}": [" ".join("".join(rng.choices("ab1", k=rng.randint(1, 4))) for _ in range(rng.randint(1, 3))) for _ in range(n)] for k, n in enumerate((400, 1, 7, 60))}
    rows = [(d, i, t) for d, ts in docs.items() for i, t in enumerate(ts)]
    pieces = spark.createDataFrame(rows, "doc_id string, ord long, text string").repartition(5)
    texts = {d: " ".join(ts) for d, ts in docs.items()}
    wanted = [("plain", texts["d0"][i : i + n].strip()) for i in range(0, 300, 41) for n in (3, 9, 30)] + [("bare", texts["d3"].replace(" ", "")[i : i + 12]) for i in range(0, 90, 7)] + [("bare", "a b"), ("plain", "zz")]
    terms = scoring.numbered_terms(spark.createDataFrame(wanted, "kind string, term string"))
    of = {r.term_id: (r.kind, r.term) for r in terms.collect()}
    got = {(r.doc_id, of[t]) for r in scoring.match_joined(pieces, terms).collect() for t in r.terms}
    bare = lambda t: t.replace(" ", "")
    assert got == {(d, (k, t)) for d, text in texts.items() for k, t in of.values() if (t in text if k == "plain" else bare(t) in bare(text))}


@pytest.mark.parametrize("part_rows,pairs", [(3, 20), (5, 4_000_000), (4096, 50), (4096, 4_000_000)])
def test_best_texts_equal_brute_force(spark, monkeypatch, part_rows, pairs):
    """A hot document with a hot set of queries, small ones, ties, other domains; in blocks and steps of any size."""
    monkeypatch.setattr(scoring, "STEP_PAIRS", pairs)
    rng = random.Random(9)
    texts = [(rng.choice(["hot", "hot", "d1", "d2", "d3"]), i, rng.choice(["", "x", "y"]), sorted(rng.sample(range(12), rng.randint(1, 6)))) for i in range(60)]
    texts = [(*t, [rng.choice([1.0, 2.5]) for _ in t[3]]) for t in texts]
    queries = [(q, rng.choice(["", "x", None]), d, rng.randint(1, 6), ts := rng.sample(range(14), rng.randint(1, 5)), [rng.choice([0.3, 1.1]) for _ in ts]) for q in range(25) for d in {"hot", rng.choice(["d1", "d2", "none"])}]
    queries = [(q, ds[0][1], *x[2:3], ds[0][3], ds[0][4], ds[0][5]) for q, ds in ((q, [x for x in queries if x[0] == q]) for q in range(25)) for x in ds]
    want = {}
    for q in range(25):
        mine = [x for x in queries if x[0] == q]
        _, asked, _, k, terms, weights = mine[0]
        found = []
        for d, i, domain, held, gains in texts:
            score = round(sum(w * gains[held.index(t)] for t, w in zip(terms, weights) if t in held), 6)
            if d in {x[2] for x in mine} and score > 0 and (not asked or domain in ("", asked)):
                found.append((-score, i))
        want[q] = [(i, -s) for s, i in sorted(found)[:k]]
    left = spark.createDataFrame(texts, "doc_id string, ord long, domain string, terms array<long>, gains array<double>")
    right = spark.createDataFrame(queries, "query long, asked string, doc_id string, k int, terms array<long>, weights array<double>")
    got = {q: [] for q in range(25)}
    for r in scoring.best_texts(left, right, part_rows).orderBy("query", "rank").collect():
        got[r["query"]].append((r.ord, r.score))
    assert got == want
    assert scoring.best_texts(left.limit(0), right).count() == 0 and scoring.best_texts(left, right.limit(0)).count() == 0


def test_documents_that_are_named(spark):
    chunks = chunk_table(spark, [(0, "c0", "d0", "research", "产能增长"), (1, "c1", "doc_7", "insurance", "别的"), (2, "c2", "d2", "", "产能")])
    questions = retrieve.distinct_questions(spark.createDataFrame([
        ("q1", "research", "A", "x", None, "mcq", None, ["d2", "d0", None, "d2"]), ("q2", "research", "B", "产能 doc_7", None, "mcq", None, []), ("q3", None, "B", "见 doc_7", None, "mcq", None, None),
    ], QUESTION))
    got = {r.qid: [] for r in questions.collect()}
    for r in recall.recalled(chunks, questions).orderBy("qid", "rank").collect():
        got[r.qid].append((r.doc_id, r.score, r.source[0], r.domain))
    assert got["q1"] == [("d2", 999.0, "p", "research"), ("d0", 999.0, "p", "research")]
    assert [x[0] for x in got["q2"]] == ["d0", "d2"] and got["q3"] == [("doc_7", 5.0, "d", "insurance")]


def test_texts_of_large_documents_come_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(retrieve, "TEXT_RANGE", 3)
    chunks = chunk_table(spark, [(i, f"c{i}", "a" if i else "b", "x" if i == 2 else "", f"t{i}") for i in (4, 0, 2, 7, 1)])
    whole = {r.doc_id: r for r in retrieve.document_texts(chunks).collect()}
    assert whole["a"].text == " t1 t2 t4 t7" and whole["a"].domain == "x" and whole["a"].ord == 1 and whole["b"].text == " t0" and {r.piece for r in whole.values()} == {0}
    parts = sorted((r.doc_id, r.piece, r.text) for r in retrieve.document_texts(chunks, 5).collect())
    assert parts == [("a", 0, " t1 t2"), ("a", 1, " t4"), ("a", 2, " t7"), ("b", 0, " t0")]


QUESTION = "qid string, domain string, split string, question string, options map<string,string>, answer_format string, type string, doc_ids array<string>"


def test_retrieval_of_ties_and_gaps(spark):
    chunks = chunk_table(spark, [(0, "c0", "d0", "research", "产能增长 2024年"), (1, "c1", "d1", "research", "产能增长 2024年"), (2, "c2", "d2", "", "产能"), (3, "c3", "d3", "insurance", "产能增长"), (4, "c4", "d0", "research", "无关")])
    questions = spark.createDataFrame([
        ("q1", "research", "A", "产能增长如何", {"A": "2024年增长"}, "mcq", None, ["d0", None]), ("q1", "research", "A", "产能增长如何", {"A": "2024年增长"}, "mcq", None, ["d0", None]),
        ("q2", "research", "B", "产能增长如何", None, "tf", None, []), ("q3", None, "B", None, None, None, None, None), (None, "research", "B", "x", None, None, None, None),
    ], QUESTION)
    got = [(r.qid, r.rank, r.chunk_id) for r in retrieve.fused_evidence(chunks, questions).collect()]
    assert {x for x in got if x[0] == "q1"} == {("q1", 1, "c0")}
    assert [x[2] for x in sorted(got) if x[0] == "q2"] == ["c0", "c2"]  # c1 repeats c0, c3 is of another domain
    assert not [x for x in got if x[0] == "q3"]
    recalled = [(r.qid, r.doc_id, r.rank) for r in recall.recall_documents(chunks, retrieve.distinct_questions(questions).where("qid = 'q2'")).collect()]
    assert sorted(recalled) == [("q2", "d0", 1), ("q2", "d1", 2), ("q2", "d2", 3)]
    assert retrieve.fused_evidence(chunks.limit(0), questions).count() == 0


def test_questions_that_recall_no_document_search_all_chunks(spark):
    late = "无" * 820 + "产能增长"  # recall reads the first 800 characters
    chunks = chunk_table(spark, [
        (0, "c0", "d0", "research", "丁" + late), (1, "c1", "d0", "insurance", "别的"), (2, "c2", "d1", "", "甲" + late), (3, "c3", "d2", "insurance", "乙" + late), (4, "c4", "d3", "research", "丙" + late),
        (5, "c5", "d4", "insurance", "保单"),
    ])
    asked = retrieve.distinct_questions(spark.createDataFrame([
        ("q1", "research", "B", "产能增长", None, "mcq", None, []), ("q2", "research", "A", "产能增长", None, "mcq", None, ["d1"]), ("q3", "research", "A", "产能增长", None, "mcq", None, [None]),
    ], QUESTION))
    candidates = retrieve.candidate_documents(asked, chunks)
    assert {tuple(r) for r in candidates.collect()} == {("q2", "d1")}
    texts = retrieve.question_texts(asked).withColumn("signals", rules.extract_signals(F.col("text"), F.col("domain")))
    restrict = texts.select("qid", "query").join(candidates, "qid").select("query", "doc_id")
    found = {(r["query"].qid, r.ord) for r in retrieve.keyword_search(chunks, texts, restrict).collect()}
    assert found == {("q1", 0), ("q1", 2), ("q1", 4), ("q2", 2), ("q3", 0), ("q3", 2), ("q3", 4)}
    bonus = texts.where("qid = 'q1'").withColumn("domain", F.lit("insurance")).withColumn("signals", rules.extract_signals(F.lit("zz"), F.lit("")))
    own = rules.DOMAIN_TERMS["insurance"]
    fillers = chunk_table(spark, [(i, f"b{i}", f"e{i % 3}", "insurance", own[0] + (own[1] if i == 7 else "")) for i in range(40)])
    ranked = sorted((r.rank, r.ord) for r in retrieve.keyword_search(fillers, bonus, restrict.limit(0)).collect())
    assert [o for _, o in ranked] == [7, *range(7), *range(8, 30)]
    assert {r.chunk_id for r in retrieve.fused_evidence(chunks, asked).where("qid = 'q1'").collect()} == {"c0", "c2", "c4"}


def test_scores(spark):
    rows = spark.createDataFrame([(1.0, 0), (1.0, 5_000_000), (0.5, 1_000_000), (1.0, 9_000_000)], "a double, t long")
    assert [round(r[0], 6) for r in rows.select(evaluate.final_score(F.col("a"), F.col("t"))).collect()] == [70.0, 70.0, 47.0, 70.0]
    gold = spark.createDataFrame([("a", "AC"), ("b", "B"), ("c", "")], "qid string, gold string")
    answers = spark.createDataFrame([("a", "AC"), ("c", "")], "qid string, answer string")
    assert {r.qid: r.correct for r in evaluate.judged(gold, answers).collect()} == {"a": 1, "b": 0, "c": 0}
    runs = spark.createDataFrame([("x", 0.5, 10, "2"), ("y", 0.5, 10, "1"), ("z", 0.6, 99, "3")], "run string, accuracy double, total_tokens long, submitted_at string")
    assert [r.run for r in evaluate.leaderboard(runs).orderBy("place").collect()] == ["z", "y", "x"]


def test_files(spark, tmp_path):
    for name, text in {"a.PDF": "p", "sub/a.txt": " 甲　 乙 ", "b.pdf": "p1\fp2", "c.doc": "x"}.items():
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_text(text, encoding="utf-8")
    got = files.read_pages(spark, str(tmp_path), reader=lambda data: data.decode().split("\f"))
    assert {(r.doc_id, r.page, r.text) for r in got.collect()} == {("a", 1, "甲 乙"), ("b", 1, "p1"), ("b", 2, "p2")}
    kept = files.prefer_sources(files.with_name(spark.createDataFrame([("x/a.pdf",), ("y/a.txt",)], "path string")), prefer_txt=False)
    assert [r.path for r in kept.collect()] == ["x/a.pdf"]
    assert files.output_layout("q/group_a/research_questions.json") == ("group_a", "research")


def test_json(spark, tmp_path):
    items = [{"text": "", "content": " 甲  乙 ", "document_id": "d"}, 3, {"chunk_text": "丙", "id": "k", "category": "x"}, {"text": " "}]
    for name, payload in {"list": items, "chunks": {"chunks": items}, "data": {"data": items}}.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(payload, ensure_ascii=False), encoding="utf-8")
        got = json_tables.load_chunks(spark, str(tmp_path / f"{name}.json")).orderBy("ord.idx").collect()
        assert [(r.chunk_id, r.doc_id, r.domain, r.text, r.ord.idx) for r in got] == [("d#0", "d", "", "甲 乙", 0), ("k", "", "x", "丙", 2)]
    (tmp_path / "q.json").write_text(json.dumps({"questions": [{"qid": "1", "options": {"A": "x"}, "doc_ids": ["d"]}]}))
    assert json_tables.load_questions(spark, str(tmp_path / "q.json")).first().options == {"A": "x"}
    (tmp_path / "bad.json").write_text(json.dumps({"other": []}))
    with pytest.raises(Exception, match="unsupported format"):
        json_tables.load_questions(spark, str(tmp_path / "bad.json")).collect()
    (tmp_path / "e.json").write_text(json.dumps([{"qid": "1", "evidence": [{"doc_id": "d", "text": "t", "metadata": {"page": 3}}]}]))
    assert json_tables.load_evidence(spark, str(tmp_path / "e.json")).first().evidence == "[证据1]\ndoc_id: d\npage: 3\ntext: t"


def test_documents_json(spark, tmp_path):
    folder = tmp_path / "insurance" / "documents"
    folder.mkdir(parents=True)
    doc = {"metadata": {"doc_id": "m1", "domain": None}, "chunks": [{"text": "甲", "retrieval_text": "标题 甲"}, {"text": ""}, {"chunk_id": "own", "text": "乙"}]}
    (folder / "m1.json").write_text(json.dumps(doc, ensure_ascii=False), encoding="utf-8")
    rows = json_tables.chunks_of_documents(json_tables.load_documents(spark, str(folder))).orderBy("chunk_index").collect()
    assert [(r.chunk_id, r.doc_id, r.domain, r.text) for r in rows] == [("m1:c0", "m1", "insurance", "标题 甲"), ("own", "m1", "insurance", "乙")]


def test_answer_csv(spark, tmp_path):
    ledger = spark.createDataFrame([("b", "", 1, 2, 3, 1), ("summary", "", 5, 6, 11, 0), ("a", "AC", 4, 4, 8, 1)], "qid string, answer string, prompt_tokens long, completion_tokens long, total_tokens long, place int")
    sinks.write_answers(ledger, str(tmp_path / "out"))
    (part,) = (tmp_path / "out").glob("*.csv")
    assert part.read_text().splitlines() == ["qid,answer,prompt_tokens,completion_tokens,total_tokens", "summary,,5,6,11", "a,AC,4,4,8", "b,,1,2,3"]


def test_stream_equals_batch(spark):
    path = "/root/testdata/sf0.001/traces.parquet"
    batch = {tuple(r) for r in token_windows(spark.read.parquet(path)).collect()}
    assert {tuple(r) for r in run_token_windows(spark, path, "t").collect()} == batch


def test_stream_of_unordered_files_equals_batch(spark, tmp_path):
    usage = "named_struct('input_tokens', 1L, 'output_tokens', 2L, 'total_tokens', 3L)"
    for i, day in enumerate([*range(28, 10, -1), 2, 1, 3, 4]):  # files lie in the order of their times of writing
        rows = spark.sql(f"SELECT {i}L AS trace_id, TIMESTAMP_NTZ '2026-01-{day:02d} 10:00:00' AS logged_at, 'research' AS domain, {usage} AS usage")
        rows.coalesce(1).write.mode("append").parquet(str(tmp_path / "traces.parquet"))
    path = str(tmp_path / "traces.parquet")
    batch = {tuple(r) for r in token_windows(spark.read.parquet(path)).collect()}
    assert len(batch) == 22 and {tuple(r) for r in run_token_windows(spark, path, "u").collect()} == batch


def test_no_questions_and_no_words(spark):
    chunks = chunk_table(spark, [(0, "c0", "d0", "research", "产能增长")])
    none = spark.createDataFrame([], QUESTION)
    assert retrieve.fused_evidence(chunks, none).count() == 0 and recall.recalled(chunks, retrieve.distinct_questions(none)).count() == 0
    silent = spark.createDataFrame([("q", None, "B", "？", None, "mcq", None, [])], QUESTION)
    assert retrieve.fused_evidence(chunks, silent).count() == 0


def test_named_documents_are_found_without_shuffling_substrings(spark):
    ids = ["d1", "文档一", "d", "x" * 40]
    asked = spark.createDataFrame([("a", "d1 见文档一"), ("b", "d"), ("c", "甲"), ("e", "x" * 50)], "qid string, query string")
    got = recall.named_in_queries(asked, spark.createDataFrame([(i,) for i in ids], "doc_id string"))
    assert sorted(map(tuple, got.collect())) == [("a", "d"), ("a", "d1"), ("a", "文档一"), ("b", "d"), ("e", "x" * 40)]
    plan = got._jdf.queryExecution().toString()
    assert "sequence(" not in plan and "NestedLoop" not in plan


def test_terms_of_queries_are_not_broadcast_by_the_driver(spark):
    wanted = spark.createDataFrame([("q", "plain", "利率", 1.0), ("q", "bare", "利率", 2.0), ("r", "plain", "期", 3.0), ("r", None, "期", 4.0), ("r", "plain", "", 5.0)], "query string, kind string, term string, weight double")
    stated = scoring.numbered_terms(wanted)
    number = {(r.kind, r.term): r.term_id for r in stated.collect()}
    got = scoring.terms_of_queries(wanted, stated, ["query"])
    assert "Broadcast" not in got._jdf.queryExecution().toString()
    assert {r.query: dict(zip(r.terms, r.weights)) for r in got.collect()} == {"q": {number["plain", "利率"]: 1.0, number["bare", "利率"]: 2.0}, "r": {number["plain", "期"]: 3.0}}
    assert scoring.terms_of_queries(wanted.limit(0), scoring.numbered_terms(wanted.limit(0)), ["query"]).count() == 0


def test_restrictions_of_a_search_are_computed_once(spark):
    texts = spark.createDataFrame([("d", 1, "", [1, 2]), ("e", 2, "", [2])], "doc_id string, ord long, domain string, terms array<long>")
    queries = spark.createDataFrame([("q", "", 5, [2], [1.0]), ("free", "", 5, [1, 2], [1.0, 1.0])], "query string, asked string, k int, terms array<long>, weights array<double>")
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    restrict = spark.createDataFrame([("q", "e")], "query string, doc_id string").mapInArrow(counted, "query string, doc_id string")
    got = scoring.search_within(texts, queries, restrict)
    assert sorted((r.query, r.ord, r.score) for r in got.collect()) == [("free", 1, 2.0), ("free", 2, 1.0), ("q", 2, 1.0)]
    assert seen.value == 1


def test_terms_of_a_search_are_counted_where_their_query_lies(spark):
    from folioscan.operators import bm25

    index = Bm25Index.build(chunk_table(spark, [(1, "a", "d", "", "net profit net"), (2, "b", "d", "", "profit cash"), (3, "c", "e", "", "other")])).kept()
    tokens = spark.createDataFrame([("q", "net profit net none"), ("none", "missing"), ("empty", ""), ("null", None)], "query string, text string")
    words = bm25.term_counts(tokens.select("query", index.tokenizer("text").alias("tokens"))).select("query", "terms", "tfs")
    stated = scoring.materialize(index.terms.select("term", "idf").withColumn("term_id", F.monotonically_increasing_id()).coalesce(1), "terms")
    got = bm25._weighted(words, stated)
    plan = got._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Broadcast" not in plan
    held, idf = {r.term: r.term_id for r in stated.collect()}, {r.term: r.idf for r in stated.collect()}
    assert {r.query: dict(zip(r.terms, r.weights)) for r in got.collect()} == {"q": {held["net"]: 2 * idf["net"], held["profit"]: idf["profit"]}}
    found = index.search(tokens.withColumn("domain", F.lit("")), top_k=5).orderBy("rank").collect()
    assert [(r.query, r.ord) for r in found] == [("q", 1), ("q", 2)]
