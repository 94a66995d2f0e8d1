"""Answers, usage, prompts and log names as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioscan.functions.text import first_filled, strip

# Texts of prompts.
INSTRUCTIONS = {
    "mcq": "只输出一个大写字母，例如：A",
    "multi": "只输出所有正确答案的大写字母，按字母顺序，不加空格或逗号，例如：AC",
    "tf": "只输出A或B",
}
OTHER_INSTRUCTION = "只输出答案字母"
SYSTEM_PROMPT = (
    "你是一个专业的金融文档问答助手。\n\n你的任务是根据提供的证据内容回答问题。\n\n请遵守以下规则：\n"
    "1. 只能根据提供的证据内容回答，不要使用证据之外的信息。\n"
    "2. 所有提供给你的证据都是出自正确的文档，无需关心doc_id的问题\n"
    "3. 如果证据不充分，最多只能重复推理一轮"
)
THINK_OPEN, THINK_CLOSE = "<think>", "</think>"
REASONING_FIELDS = ("reasoning_content", "reasoning", "thought", "thinking")


def parse_answer(raw: Column, answer_format: Column, strict_case: bool = False) -> Column:
    """the letters A to D of an answer: the first, or for multi all of them, sorted, each once; none is an empty text.

    The whole answer is upper-cased first, so prose in lower case yields letters too, unless strict_case is set.
    """
    text = F.coalesce(raw, F.lit(""))
    letters = F.regexp_extract_all(text if strict_case else F.upper(text), F.lit("[A-D]"), F.lit(0))
    every = F.array_join(F.array_sort(F.array_distinct(letters)), "")
    return F.when(answer_format == "multi", every).otherwise(F.coalesce(F.get(letters, F.lit(0)), F.lit("")))


def split_think(content: Column) -> Column:
    """struct of reasoning and answer; without a complete block the reasoning is empty and the answer the content."""
    text = F.coalesce(content, F.lit(""))
    opened = F.instr(text, THINK_OPEN)
    start = opened + len(THINK_OPEN)
    closed = F.locate(THINK_CLOSE, text, 1)
    inner_end = F.when(opened > 0, F.instr(F.substr(text, start), THINK_CLOSE)).otherwise(F.lit(0))
    complete = (opened > 0) & (closed > 0) & (inner_end > 0)
    inner = F.substr(text, start, inner_end - 1)
    rest = F.concat(F.substr(text, F.lit(1), opened - 1), F.substr(text, start + inner_end - 1 + len(THINK_CLOSE)))
    return F.struct(
        F.when(complete, strip(inner)).otherwise(F.lit("")).alias("reasoning"), F.when(complete, strip(rest)).otherwise(text).alias("answer")
    )


def reasoning_and_content(content: Column, *fields: Column) -> Column:
    """the first filled reasoning field with the content as it is, else split_think of the content."""
    given, split = first_filled(*(fields or (F.lit(None).cast("string"),))), split_think(content)
    return F.struct(F.coalesce(given, split["reasoning"]).alias("reasoning"), F.when(given.isNotNull(), content).otherwise(split["answer"]).alias("answer"))


def prompt_tokens(usage: Column, names: tuple[str, ...] = ("input_tokens",)) -> Column:
    """the first field that is not null, else 0."""
    return F.coalesce(*(usage[n] for n in names), F.lit(0)).cast("long")


def completion_tokens(usage: Column, names: tuple[str, ...] = ("output_tokens",)) -> Column:
    return F.coalesce(*(usage[n] for n in names), F.lit(0)).cast("long")


def total_tokens(usage: Column) -> Column:
    """the total, or where that is 0 or null the sum of prompt and completion."""
    total = F.coalesce(usage["total_tokens"], F.lit(0)).cast("long")
    return F.when(total != 0, total).otherwise(prompt_tokens(usage) + completion_tokens(usage))


def logged_total(usage: Column) -> Column:
    """as total_tokens, but a total of 0 is kept."""
    return F.coalesce(usage["total_tokens"].cast("long"), prompt_tokens(usage) + completion_tokens(usage))


def safe_filename(name: Column) -> Column:
    """other characters than letters, digits, _, . and - become _; dots and _ at the ends go; nothing left is 'unknown'."""
    text = F.coalesce(F.when(name != "", name), F.lit("unknown"))
    safe = F.btrim(F.regexp_replace(text, "[^A-Za-z0-9_.-]+", "_"), F.lit("._"))
    return F.when(safe == "", "unknown").otherwise(safe)


def trace_path(run_time: Column, answer_time: Column, domain: Column, qid: Column, usage: Column) -> Column:
    """K7: folder and file name of a trace."""
    day = F.date_format(run_time, "yyyyMMdd")
    stamp = lambda t: F.date_format(t, "HHmmssSSSSSS")
    return F.concat(
        day, F.lit("-"), stamp(run_time), F.lit("-Conversation/"), day, F.lit("-"), safe_filename(domain), F.lit("/"), stamp(answer_time), F.lit("_"),
        safe_filename(F.coalesce(F.when(qid != "", qid), F.lit("no_qid"))), F.lit("_tokens-"), logged_total(usage).cast("string"), F.lit(".json"),
    )


def evidence_text(evidence: Column) -> Column:
    """Numbered blocks of an array of structs with doc_id, page and text; null fields are empty."""
    block = lambda e, i: F.concat(
        F.lit("[证据"), (i + 1).cast("string"), F.lit("]\ndoc_id: "), F.coalesce(e["doc_id"], F.lit("")), F.lit("\npage: "),
        F.coalesce(e["page"].cast("string"), F.lit("")), F.lit("\ntext: "), F.coalesce(e["text"], F.lit("")),
    )
    return F.coalesce(F.array_join(F.transform(evidence, block), "\n\n"), F.lit(""))


def build_prompt(question: Column, options: Column, evidence: Column, answer_format: Column) -> Column:
    """the user prompt; options are a map, in its order, and evidence is left out where it is empty."""
    lines = F.array_join(F.transform(F.map_entries(options), lambda o: F.concat(o["key"], F.lit(". "), F.coalesce(o["value"], F.lit("")), F.lit("\n"))), "")
    how = F.lit(OTHER_INSTRUCTION)
    for name, text in INSTRUCTIONS.items():
        how = F.when(answer_format == name, text).otherwise(how)
    has = F.coalesce(evidence, F.lit("")) != ""
    return F.concat(
        F.when(has, F.concat(F.lit("\n\n【证据材料】\n"), evidence)).otherwise(""),
        F.lit("\n\n【题目】\n"), F.coalesce(question, F.lit("")), F.lit("\n\n【选项】\n"), F.coalesce(lines, F.lit("")), F.lit("\n【要求】\n"),
        F.when(has, "严格依据证据材料作答。\n").otherwise(""), how, F.lit("\n\n答案："),
    )


def messages(prompt: Column) -> Column:
    """system and user message."""
    message = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return F.array(message("system", F.lit(SYSTEM_PROMPT)), message("user", prompt))
