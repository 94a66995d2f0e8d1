import json

import pytest
from pyspark.sql import functions as F

from folioscan import __main__ as command
from folioscan import jobs
from folioscan.operators import retrieve
from folioscan.sources import files, json_tables, sinks

QUESTIONS = [
    {"qid": "q1", "domain": "research", "split": "A", "question": "产能增长如何", "options": {"A": "增长", "B": "下降"}, "answer_format": "mcq", "doc_ids": ["one"]},
    {"qid": "q2", "domain": "research", "split": "B", "question": "第二章的目标价", "options": {"A": "买入", "B": "卖出"}, "answer_format": "multi"},
    {"qid": "q3", "domain": "other", "split": "B", "question": "无人回答", "options": {}, "answer_format": "tf"},
]
TRACE = "trace_id long, logged_at timestamp, qid string, answer string, reasoning string, usage struct<input_tokens:bigint,output_tokens:bigint,total_tokens:bigint>, model string"


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    """Raw files and questions on disk, processed."""
    base = tmp_path_factory.mktemp("jobs")
    raw = base / "raw" / "research"
    (raw / "sub").mkdir(parents=True)
    (raw / "one.txt").write_text("第一章 总则\n产能增长百分之五。\n第二条 其他\n内容。", encoding="utf-8")
    (raw / "one.pdf").write_text('["不读"]')
    (raw / "sub" / "two.PDF").write_text(json.dumps(["目录\n第二章 目标价......3", "第二章 目标价\n目标价为30元。", "续页，第三章之前。", ""], ensure_ascii=False))
    (raw / "empty.txt").write_text("")
    asked = base / "questions" / "group_a"
    asked.mkdir(parents=True)
    (asked / "research_questions.json").write_text(json.dumps(QUESTIONS[:1], ensure_ascii=False), encoding="utf-8")
    (asked / "more_questions.json").write_text(json.dumps({"data": QUESTIONS[1:]}, ensure_ascii=False), encoding="utf-8")
    config = jobs.ProcessConfig(str(base / "raw"), str(asked / "research_questions.json"), f"file://{base}/out", reader=json.loads)
    index = {r.doc_id: r for r in jobs.process(spark, config).collect()}
    return base, config, index


def test_process(spark, root):
    base, config, index = root
    assert config.output_subdir == f"file://{base}/out/group_a/research"
    assert {k: (r.page_count, r.source_type, r.domain) for k, r in index.items()} == {"one": (1, "txt", "research"), "two": (4, "pdf", "research"), "empty": (1, "txt", "research")}
    two = json.loads((base / "out/group_a/research/documents/two.json").read_text(encoding="utf-8"))
    assert two["toc"] == [{"title": "第二章 目标价", "target_page": 3, "source_page": 1}]
    assert [p["page_type"] for p in two["pages"]] == ["toc", "content", "content", "empty"]
    assert two["pages"][2]["segments"] == [{"title": "第二章 目标价", "text": "续页，第三章之前。", "hierarchy": {"chapter": "第二章 目标价"}, "keywords": ["第二章 目标价"]}]
    assert two["char_count"] == index["two"].char_count == sum(len(s["text"]) for p in two["pages"] for s in p["segments"])
    assert index["empty"].char_count == 0
    with pytest.raises(FileNotFoundError, match="raw_dir"):
        jobs.process(spark, jobs.ProcessConfig(str(base / "none"), config.question_file, config.output_dir))
    with pytest.raises(FileNotFoundError, match="question_file"):
        jobs.process(spark, jobs.ProcessConfig(config.raw_dir, str(base / "none.json"), config.output_dir))


def test_chunks_of_roots(spark, root, tmp_path):
    base, config, _ = root
    other = tmp_path / "insurance" / "documents"
    other.mkdir(parents=True)
    (other / "m.json").write_text(json.dumps({"metadata": {"doc_id": "m"}, "chunks": [{"text": "甲", "retrieval_text": "题 甲"}]}, ensure_ascii=False), encoding="utf-8")
    rows = {r.chunk_id: r for r in jobs.build_chunks(spark, [config.output_subdir, str(tmp_path / "insurance")]).collect()}
    assert rows["m:c0"].text == "题 甲" and rows["m:c0"].domain == "insurance"
    assert rows["one:p1:s0:c0"].text == "第一章 总则 第一章 总则 第一章 总则 第一章 总则 产能增长百分之五。"
    assert {k for k in rows if k.startswith("two")} == {"two:p2:s0:c0", "two:p3:s0:c0"}
    bare = tmp_path / "bare" / "documents"
    bare.mkdir(parents=True)
    (bare / "x.json").write_text("{}")
    with pytest.raises(ValueError, match="no chunks"):
        jobs.build_chunks(spark, [str(tmp_path / "bare")])


def test_evidence_and_answers(spark, root, tmp_path):
    base, config, _ = root
    asked = [str(base / "questions/group_a/research_questions.json"), str(base / "questions/group_a/more_questions.json")]
    chunks = jobs.build_chunks(spark, [config.output_subdir]).withColumn("ord", F.monotonically_increasing_id())
    found = {r.qid: r for r in jobs.generate_evidence(spark, chunks, asked, str(tmp_path / "evidence")).collect()}
    assert found["q1"].candidate_doc_ids == ["one"] and {e.doc_id for e in found["q1"].evidence} == {"one"} and found["q1"].evidence[0]["rank"] == 1
    assert [e.doc_id for e in found["q2"].evidence][0] == "two" and found["q3"].evidence is None and set(found) == {"q1", "q2", "q3"}
    day = "2026-01-0{} 00:00:00"
    traces = spark.createDataFrame([
        (1, None, "q1", "B", None, (1, 2, 3), "m"), (2, None, "q2", "<think>或许D</think>选A和C", "", (10, 5, 0), "m"), (3, None, "other", "A", None, None, "m"),
    ], TRACE).withColumn("logged_at", F.to_timestamp(F.format_string(day.replace("{}", "%d"), F.col("trace_id"))))
    traces = traces.unionByName(traces.where("trace_id = 1").withColumn("trace_id", F.lit(9).cast("long")).withColumn("answer", F.lit("A")).withColumn("logged_at", F.to_timestamp(F.lit(day.format(9)))))
    texts = json_tables.load_evidence(spark, str(tmp_path / "evidence"), lines=True)
    questions = retrieve.distinct_questions(json_tables.load_questions(spark, asked))
    ledger = {r.qid: (r.answer, r.prompt_tokens, r.completion_tokens, r.total_tokens) for r in jobs.run_answers(questions, texts, jobs.Replay(traces), str(tmp_path / "answers")).collect()}
    assert ledger == {"q1": ("A", 1, 2, 3), "q2": ("AC", 10, 5, 15), "q3": ("", 0, 0, 0), "summary": ("", 11, 7, 18)}
    (part,) = (tmp_path / "answers").glob("*.csv")
    assert [line.split(",")[0] for line in part.read_text().splitlines()] == ["qid", "summary", "q1", "q2", "q3"]

    def call(messages):
        assert [m["role"] for m in messages] == ["system", "user"]
        return {"content": "答案是A" if "产能增长" in messages[1]["content"] else "因B", "usage": {"input_tokens": 4, "output_tokens": 1, "total_tokens": None}}

    (tmp_path / "one.json").write_text(json.dumps([{"qid": "q1", "evidence": [{"doc_id": "one", "text": "t", "metadata": {"page": 1}}]}]))
    called = {r.qid: (r.answer, r.total_tokens) for r in jobs.answer_questions(spark, asked, str(tmp_path / "one.json"), jobs.Client(call), str(tmp_path / "more")).collect()}
    assert called == {"q1": ("A", 5), "q2": ("B", 5), "q3": ("B", 5), "summary": ("", 15)}


def test_files_of_rows(spark, tmp_path):
    rows = spark.createDataFrame([("a/x.txt", "甲"), ("a/b/y.txt", None), ("z.txt", "")], "path string, content string")
    for _ in range(2):
        assert sinks.write_each(rows, f"file://{tmp_path}/out") == 3
    assert (tmp_path / "out/a/x.txt").read_text(encoding="utf-8") == "甲" and (tmp_path / "out/a/b/y.txt").read_bytes() == b""
    scanned = {r.doc_id: bytes(r.content) for r in files.scan_files(spark, f"file://{tmp_path}/out").collect()}
    assert scanned == {"x": "甲".encode(), "y": b"", "z": b""}
    assert sinks.write_each(rows.limit(0), f"file://{tmp_path}/none") == 0


def test_nested_values(spark):
    row = spark.createDataFrame([('{"a": [{"b": 3}], "c": null}',), ("no json",), (None,)], "j string")
    got = row.select(json_tables.nested(F.col("j"), "a", 0, "b"), json_tables.nested(F.col("j"), "a", 1, "b"), json_tables.nested(F.col("j"), "c")).collect()
    assert [tuple(r) for r in got] == [("3", None, None), (None, None, None), (None, None, None)]


def test_command_line(spark, tmp_path, capsys):
    (tmp_path / "chunks.json").write_text(json.dumps({"chunks": [{"chunk_id": "a", "text": "产能增长", "page": 7}, {"chunk_id": "b", "text": "保险责任"}]}, ensure_ascii=False), encoding="utf-8")
    found = command.main(["--chunks", str(tmp_path / "chunks.json"), "--save", str(tmp_path / "ix"), "--query", "产能", "--top-k", "3"], spark)
    assert [f["chunk_id"] for f in found] == ["a"] and found[0]["metadata"]["page"] == 7 and json.loads(capsys.readouterr().out) == found
    assert (tmp_path / "ix" / "terms").exists() and command.main(["--chunks", str(tmp_path / "chunks.json")], spark) == []
