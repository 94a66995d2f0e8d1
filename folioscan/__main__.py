"""Build an index of a chunk file, keep it, and search it: python -m folioscan --chunks chunks.json [--lines] [--save DIR] [--query TEXT] [--top-k N]."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession

from folioscan.operators.bm25 import Bm25Index
from folioscan.session import local_session
from folioscan.sources import json_tables


def search_text(index: Bm25Index, chunks: DataFrame, text: str, top_k: int) -> list[dict]:
    """The best chunks of one query text, as the index and the chunks have them."""
    asked = chunks.sparkSession.createDataFrame([(text, "", text)], "query string, domain string, text string")
    found = index.search(asked, top_k=top_k).select("ord", "rank", "chunk_id", "doc_id", "domain", "score")
    rows = found.join(chunks.select("ord", "text", "metadata"), "ord").orderBy("rank").collect()  # top_k at most
    return [{n: r[n] for n in ("chunk_id", "doc_id", "domain", "text", "score")} | {"source": "bm25", "metadata": json.loads(r.metadata)} for r in rows]


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> list[dict]:
    parser = argparse.ArgumentParser(prog="folioscan", description="Build or query a BM25 index of chunks.")
    parser.add_argument("--chunks", default="chunks.json", help="chunk file, or a folder of JSON lines with --lines")
    parser.add_argument("--lines", action="store_true", help="chunks are JSON lines")
    parser.add_argument("--save", help="folder for the index")
    parser.add_argument("--query", help="query text")
    parser.add_argument("--top-k", type=int, default=10)
    given = parser.parse_args(arguments)
    spark = spark or SparkSession.getActiveSession() or local_session()
    chunks = json_tables.load_chunks(spark, given.chunks, given.lines)
    index = Bm25Index.build(chunks).kept()
    if given.save:
        index.save(given.save)
    found = search_text(index, chunks, given.query, given.top_k) if given.query else []
    if given.query:
        print(json.dumps(found, ensure_ascii=False, indent=2))
    return found


if __name__ == "__main__":
    main()
