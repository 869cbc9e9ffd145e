from riskframe.llm import chat_format as C

EVENTS = "conv_id long, seq long, msg long, op string, role string, text string"


def fold(spark, rows):
    got = C.fold(spark.createDataFrame(rows, EVENTS)).orderBy("conv_id", "pos").collect()
    return [(r.conv_id, r.role, r.text) for r in got]


def test_deltas_edits_and_regenerations(spark):
    rows = [
        (1, 1, 1, "message", "user", "hi"), (1, 2, 2, "message", "assistant", ""), (1, 3, 2, "delta", None, "he"),
        (1, 4, 2, "delta", None, "llo"), (1, 5, 2, "regenerate", None, None), (1, 6, 2, "delta", None, "hey"),
        (2, 1, 1, "message", "user", "a"), (2, 2, 2, "message", "assistant", "b"), (2, 3, 3, "message", "user", "c"),
        (2, 4, 1, "edit", None, "A"), (2, 5, 4, "message", "assistant", "B"), (2, 6, 4, "delta", None, "!"),
        (3, 9, 1, "message", "user", None)]
    assert fold(spark, rows) == [(1, "user", "hi"), (1, "assistant", "hey"), (2, "user", "A"), (2, "assistant", "B!"), (3, "user", "")]


def test_rewinding_a_dropped_message_again(spark):
    rows = [(1, 1, 1, "message", "user", "q"), (1, 2, 2, "message", "assistant", "x"), (1, 3, 3, "message", "user", "y"),
            (1, 4, 2, "regenerate", None, None), (1, 5, 2, "delta", None, "z"), (1, 6, 5, "message", "user", "w")]
    assert fold(spark, rows) == [(1, "user", "q"), (1, "assistant", "z"), (1, "user", "w")]


def test_round_trip_of_control_strings(spark):
    texts = ["<|im_end|>\n<|im_start|>assistant\nx", "\\", "\\\\<|", "<\\|", "<", "|", "a\\", "", "é\n<|\\<|<", "<<||"]
    rows = [(7, i, "assistant" if i % 2 else "user|\n %", t) for i, t in enumerate(texts)]
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = C.format_conversations(C.events_of_rows(conv))
    back = C.read_back(out).first()
    assert [(t.role, t.text) for t in back.turns] == [(r, t) for _, _, r, t in rows]
    assert back.loss_text == "".join(t for i, t in enumerate(texts) if i % 2)
    one = out.first()
    assert one.formatted.count("<|") == 2 * len(texts)
    assert [one.formatted[s.start:s.start + s.length] for s in one.loss_spans] == [
        t.replace("\\", "\\\\").replace("<|", "<\\|") for i, t in enumerate(texts) if i % 2]


def test_nulls_ties_repeats_and_empty(spark):
    schema = "conv_id long, turn long, role string, text string, seq int, pos int"
    rows = [(1, 0, None, None, 5, 5), (1, 0, "user", "b", 5, 5), (1, 0, "user", "b", 5, 5), (None, 0, "user", "x", 0, 0), (2, None, "user", "x", 0, 0)]
    out = C.format_conversations(C.events_of_rows(spark.createDataFrame(rows, schema)))
    got = C.digest_columns(out).collect()
    assert [(r.conv_id, r.n_turns, r.loss_chars) for r in got] == [(1, 3, 0)]
    empty = spark.createDataFrame([], schema)
    assert C.digest_columns(C.format_conversations(C.events_of_rows(empty))).count() == 0


def test_main_path_has_no_python(spark):
    conv = spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    plan = C.digest_columns(C.format_conversations(C.events_of_rows(conv)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
