import duckdb

from strikepath.llm import preference
from strikepath.llm.queries import ORACLE_SQL

TURNS = "conv_id bigint, turn bigint, role string, text string, start string, part string, prefix string"


def turns(spark, rows):
    return spark.createDataFrame([(*r, None, None, None) for r in rows], TURNS)


CONVERSATIONS = {
    1: ["hi", "hello", "how", "fine"],
    2: ["hi", "hello", "how", "bad", "why"],
    3: ["hi", "hello"],
    6: ["hi", "hey", "how"],
    7: ["other", "x"],
    8: ["alone"],
}
ROWS = [(c, t, "user" if t % 2 == 0 else "assistant", x) for c, texts in CONVERSATIONS.items() for t, x in enumerate(texts)]


def render(role, text):
    return f"<|{role}|>\n{text}\n"


def brute(pairs):
    out = []
    for a, b in pairs:
        x, y = ([("user" if t % 2 == 0 else "assistant", s) for t, s in enumerate(CONVERSATIONS.get(c, []))] for c in (a, b))
        n = 0
        while n < min(len(x), len(y)) and x[n] == y[n]:
            n += 1
        for part, own in (("prompt", y[:n]), ("chosen", x[n:]), ("rejected", y[n:])):
            at = 0
            for role, text in own:
                counts = part != "prompt" and role == "assistant"
                begin = at + len(f"<|{role}|>\n") if counts else at
                out.append((a, b, part, render(role, text), at, begin, begin + len(text) if counts else at))
                at += len(render(role, text))
    return sorted(out)


def shown(df):
    return sorted((r["chosen_id"], r["rejected_id"], r["part"], r["rendered"], r["start"], r["loss_start"], r["loss_end"]) for r in df.collect())


def test_pairs_and_parts_equal_brute_force(spark):
    pairs = {(r["chosen_id"], r["rejected_id"]) for r in preference.pairs_of(turns(spark, ROWS)).collect()}
    assert pairs == {(3, 1), (3, 2), (3, 6), (2, 3), (6, 7)}
    assert shown(preference.format_preferences(turns(spark, ROWS * 2))) == brute(pairs)
    given = spark.createDataFrame([(1, 2), (2, 1), (1, 99), (99, 1), (None, 1)], "chosen_id bigint, rejected_id bigint")
    assert shown(preference.format_pairs(turns(spark, ROWS), given)) == brute([(1, 2), (2, 1), (1, 99), (99, 1)])


def test_long_conversation_spans_blocks(spark):
    long = [(c, t, "assistant", f"t{t}" if t < 3000 else f"c{c}") for c in (0, 1) for t in range(3005)]
    out = preference.format_preferences(turns(spark, long)).groupBy("part").count().collect()
    assert {r["part"]: r["count"] for r in out} == {"prompt": 3000, "chosen": 5, "rejected": 5}


def test_odd_rows(spark):
    rows = [(0, None, None, None), (0, 0, "user", ""), (0, 0, "user", ""), (0, 0, "assistant", "tie"), (1, 0, "user", None), (None, 0, "user", "x")]
    df = turns(spark, rows)
    db = duckdb.connect()
    db.register("conversations", df.select("conv_id", "turn", "role", "text").toPandas().astype({"conv_id": "Int64", "turn": "Int64"}))
    theirs = db.execute(ORACLE_SQL["op8_preferences"]).df()
    got = preference.format_preferences(df).toPandas()
    key = ["chosen_id", "rejected_id", "part", "start"]
    assert got.sort_values(key)[list(theirs.columns)].astype(str).values.tolist() == theirs.sort_values(key).astype(str).values.tolist()
    assert preference.format_preferences(turns(spark, [])).count() == 0
