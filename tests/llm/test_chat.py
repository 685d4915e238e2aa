import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from trailmark.llm.chat import assemble, control_rows, escape, escape_role, format_turns, parse, read_back, render, unescape

tricky = st.text(alphabet=st.sampled_from(list("<|>\\ai_menstrd\n é🎉")), max_size=40)


@settings(deadline=None)
@given(tricky)
def test_escaping_is_reversible(t):
    assert "<|" not in escape(t) and unescape(escape(t)) == t


@settings(deadline=None)
@given(tricky, tricky)
def test_turn_round_trip(role, text):
    for r in (role, "assistant"):
        ids, mask = assemble(r, text)
        learned = text if r == "assistant" else ""
        assert parse(ids.tolist(), mask.tolist()) == (r, text, learned)
        s = render(ids.tolist())
        assert s.count("<|im_start|>") == s.count("<|im_end|>") == 1 and s.startswith("<|im_start|>") and s.endswith("<|im_end|>\n")


def want(rows):
    by = {}
    for c, t, r, x in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0)):
        by.setdefault(c, []).append((r or "", x or ""))
    out = {}
    for c, turns in by.items():
        said, learned = "".join(f"{r}\n{x}\n" for r, x in turns), "".join(x for r, x in turns if r == "assistant")
        chars = sum(len(escape_role(r)) + len(escape(x)) + 24 for r, x in turns)
        out[c] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest(), chars)
    return out


def test_read_back(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [tuple(r) for r in control_rows(spark).collect()]
    rows += [(None, 1, "user", "no id"), (9000, 2, None, None), (9000, None, "assistant", "<\\|x"), (9001, 0, "a\nb", "c"), (9002, 5, "user", "same"), (9002, 5, "user", "same")]
    rows += [(9003, k, "assistant" if k % 2 else "user", f"turn {k}") for k in range(3000)] + [(9004, 0, "assistant", "long " * 100_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as ids", "2 as n_chars")
    turns = format_turns(df)
    assert turns.count() == len(rows)
    got = {r["conv_id"]: tuple(r)[1:] for r in read_back(turns).collect()}
    assert got == want(rows)
    sums = {r["conv_id"]: r["n"] for r in turns.groupBy("conv_id").agg({"n_chars": "sum"}).withColumnRenamed("sum(n_chars)", "n").collect()}
    assert sums == {c: v[4] for c, v in got.items()}
    assert read_back(format_turns(df.limit(0))).collect() == []
