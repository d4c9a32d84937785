import hashlib
from collections import defaultdict

import pytest
from hypothesis import given, settings, strategies as st

from periodica.llm.chat import OP2_SQL, PROBE, digest, op2_chat_prefix, prefix_examples

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"


def _brute(rows):
    convs = defaultdict(list)
    for c, t, role, text in rows:
        convs[c].append(((t is not None, t), (role is not None, role), (text is not None, text)))
    out = {}
    for c, turns in convs.items():
        turns = [(r[1] or "", x[1] or "") for _, r, x in sorted(turns)]
        whole = "".join(f"{r}\n{x}\n" for r, x in turns)
        loss = "".join(x for r, x in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def _check(spark, rows):
    got = digest(prefix_examples(spark.createDataFrame(rows, SCHEMA))).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == _brute(rows)


NASTY = ["", None, "\\", "\\\\", "<|", "<\\|", "<|end|>", "<|turn|>user<|text|>x<|end|>", PROBE, "[INST", "[\\INST]", "a\n<s>b</s>",
         "<<||>>", "é😀<|", "\\<|end|>\\", "$1 \\1"]


def test_round_trip_of_control_strings(spark):
    rows = [(i, t, r, x) for i, x in enumerate(NASTY) for t, r in enumerate(["user", "assistant", x])]
    rows += [(None, 0, "assistant", "null id"), (100, None, "user", "q"), (100, None, "user", "q"), (100, 1, None, None)]
    _check(spark, rows)


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3), st.sampled_from(["user", "assistant", "system", None]),
                          st.text(alphabet="<|>\\/s[]INSTendturx \n", max_size=14)), min_size=1, max_size=12))
def test_round_trip(spark, rows):
    _check(spark, rows)


def test_examples(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (1, 2, "user", "more"), (1, 3, "assistant", "<|end|>"), (1, 4, "user", "bye")]
    ex = sorted(prefix_examples(spark.createDataFrame(rows, SCHEMA)).collect(), key=lambda r: r.example)
    assert [r.trainable for r in ex] == [True, True, False] and [r.n_turns for r in ex] == [2, 4, 5]
    assert [r.text[r.loss_start:r.loss_end] for r in ex] == ["yo", "<\\|end|>", ""]
    assert ex[1].text.startswith(ex[0].text) and ex[2].text.startswith(ex[1].text)


def test_empty_and_clashing_columns(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert digest(prefix_examples(none)).count() == 0
    more = spark.createDataFrame([(1, 0, "assistant", "a", 5, "t")], SCHEMA + ", example long, _s string")
    assert prefix_examples(more).collect()[0].example == 0


def test_query_matches_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    want = con.execute(OP2_SQL)
    names = [d[0] for d in want.description]
    got = op2_chat_prefix(spark, SF).select(*names)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
