import hashlib
import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spendlake.llm import chat_format as C

HARD = ["", "\\", "\\b", "\\c\\o", "<turn>", "</turn>\n", "\\### Assistant: </turn> ok", "a\nb", "<turn></turn>", "\\\\</turn>\\", "é \x00 \u2028", None]


def made(spark, records):
    return C.format_chat(spark.createDataFrame([(i, r) for i, r in enumerate(records)], "k long, record string"))


def read_back(df):
    turns = {r["k"]: [(t["role"], t["text"]) for t in r["t"]] for r in df.select("k", C.read_turns(F.col("formatted")).alias("t")).collect()}
    return turns


def test_layouts_become_canonical_turns(spark):
    records = [
        {"messages": [{"role": "user", "content": "a"}, {"content": "b", "role": "assistant"}]},
        {"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]},
        {"instruction": "a", "input": "x", "output": "b"}, {"instruction": "a", "input": None, "output": "b"}, {"output": "b", "instruction": "a"},
        {"prompt": "a", "completion": "b"}, {"prompt": "a", "response": "b"}, {"system": "s", "prompt": "a", "response": "b"},
        {"prompt": {"system": "s", "user": "a"}, "response": "b"}, {"messages": [{"role": None, "content": None}]}, {"other": 1}, {"messages": []},
    ]
    texts = [json.dumps(r) for r in records] + ["no json", None, ""]
    out = made(spark, texts)
    a, b, s = ("user", "a"), ("assistant", "b"), ("system", "s")
    got = read_back(out)
    assert [got[i] for i in range(len(texts))] == [[a, b], [a, b], [("user", "a\n\nx"), b], [a, b], [a, b], [a, b], [a, b], [s, a, b], [s, a, b], [("", "")], [], [], [], [], []]
    layouts = [r["layout"] for r in out.orderBy("k").collect()]
    assert layouts[:9] == ["messages", "conversations", "instruction", "instruction", "instruction_only", "prompt", "prompt_response", "system_prompt", "nested_prompt"]
    assert layouts[9] == "messages" and layouts[10:] == [None] * 5


def test_round_trip_of_control_strings(spark):
    turns = [[("user", t), ("assistant", t), (t, "x")] for t in HARD]
    out = made(spark, [json.dumps({"messages": [{"role": r, "content": c} for r, c in x]}) for x in turns])
    got = read_back(out)
    assert [got[i] for i in range(len(turns))] == [[(r or "", c or "") for r, c in x] for x in turns]
    for r in out.collect():
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="\\<>/turnboc\nx", max_size=30), min_size=20, max_size=60))
def test_escapes_restore_any_text(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k long, t string")
    got = {r["k"]: r["u"] for r in df.select("k", C.unescaped(C.escaped(F.col("t"))).alias("u")).collect()}
    assert [got[i] for i in range(len(texts))] == texts


def test_rows_by_turn_with_nulls_ties_and_repeats(spark):
    rows = [(1, 1, "assistant", "second"), (1, 0, "user", "first"), (1, 0, "user", None), (2, 0, None, "x"), (2, 0, None, "x"), (None, 0, "user", "y"), (3, None, "assistant", "z" * 100_000)]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    got = {r["conv_id"]: r for r in C.chat_digests(C.format_chat(C.records_of_turns(df), keep=["conv_id"])).collect()}
    for conv in (1, 2, 3, None):
        own = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv))
        line = "".join(f"{r}\n{x}\n" for _, _, r, x in own)
        loss = "".join(x for _, _, r, x in own if r == "assistant")
        assert got[conv]["n_turns"] == len(own) and got[conv]["turns_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert got[conv]["loss_chars"] == len(loss) and got[conv]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert C.chat_digests(C.format_chat(C.records_of_turns(df.limit(0)), keep=["conv_id"])).collect() == []


def test_no_python_in_the_plan(spark):
    from spendlake.llm.queries import QUERIES
    from tests.llm.helpers import SF
    plan = QUERIES["op4_chat_format"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_texts_longer_than_the_json_parser_reads_are_kept_or_reported(spark):
    n = C.JSON_CHARS + 1
    rows = spark.range(2).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                 F.when(F.col("id") == 0, F.repeat(F.lit("z"), n)).otherwise("short").alias("text"))
    got, = C.chat_digests(C.format_chat(C.records_of_turns(rows), keep=["conv_id"])).collect()
    assert (got["n_turns"], got["loss_chars"]) == (2, 5)
    assert got["turns_sha256"] == hashlib.sha256(b"user\n" + b"z" * n + b"\nassistant\nshort\n").hexdigest()
    wrap = lambda x: F.concat(F.lit('{"prompt":"'), x, F.lit('","response":"b"}'))
    json_texts = spark.range(3).select("id", F.when(F.col("id") == 0, wrap(F.repeat(F.lit("z"), n))).when(F.col("id") == 1, wrap(F.lit("a"))).otherwise("no json").alias("record"))
    assert {r["id"]: r["status"] for r in C.format_chat(json_texts).select("id", "status").collect()} == {0: "too large", 1: "ok", 2: "no layout"}


def test_fingerprints_of_types_are_those_of_samples(spark):
    from pyspark.sql import types as T
    for x in C.LAYOUTS:
        assert spark.range(1).select(C.fingerprint(F.lit(x.sample))).first()[0] == C.typed_fingerprint(T._parse_datatype_string(x.schema))
