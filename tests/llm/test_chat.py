import hashlib

from contactgate.llm import chat
from pyspark.sql import functions as F

SCHEMA = "conv_id long, turn long, role string, text string, extra int"
ODD = ["\\### Assistant: </turn> ok", "</turn>\n### user: hi", "\\\\h \\l # <", "", None, "ends with \\", "#" * 7, "a\nb", "é😀" * 3, ": \\c:"]


def _formatted(spark, rows):
    return chat.format_paths(chat.paths(chat.linear_trees(spark.createDataFrame(rows, SCHEMA))))


def test_reads_back_everything(spark):
    rows = [(c, t, ["user", "assistant", "sys: #tem", None][t % 4], ODD[(c + t) % len(ODD)], 0) for c in range(12) for t in range(c + 1)]
    made = _formatted(spark, rows).select("tree", chat.read_turns(F.col("formatted")).alias("turns"),
                                          chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    assert len(made) == 12
    for r in made:
        own = [(role or "", text or "") for c, _, role, text, _ in rows if c == r["tree"]]
        assert [(t["role"], t["text"]) for t in r["turns"]] == own
        assert r["loss"] == [text for role, text in own if role == "assistant"]


def test_ties_repeats_null_ids_and_empty(spark):
    rows = [(1, 0, "user", "b", 0), (1, 0, "user", "a", 0), (1, 0, "user", "a", 0), (None, 1, "user", "x", 0), (None, 0, "user", "w", 0), (2, None, "user", "n", 0)]
    made = {r["tree"]: [t["text"] for t in r["turns"]] for r in
            _formatted(spark, rows).select("tree", chat.read_turns(F.col("formatted")).alias("turns")).collect()}
    assert made == {1: ["a", "a", "b"], None: ["w", "x"], 2: ["n"]}
    assert _formatted(spark, [r for r in rows if r[0] == 99] or spark.createDataFrame([], SCHEMA).collect()).count() == 0


def _tree(spark, rows):
    return spark.createDataFrame(rows, "tree long, id long, parent long, role string, text string, score double")


def test_branches_are_ranked(spark):
    rows = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "good", 2.0), (1, 3, 1, "assistant", "bad", 1.0),
            (1, 4, 3, "user", "more", 0.5), (1, 5, 2, "user", "thanks", None), (1, 6, 99, "user", "lost", 0.1),
            (2, 1, 2, "user", "cycle", 9.0), (2, 2, 1, "user", "cycle", 9.0), (3, 7, None, "user", "alone", None)]
    got = chat.paths(_tree(spark, rows), per_tree=2).orderBy("tree", "rank", "depth").collect()
    assert [(r["tree"], r["rank"], r["leaf"], r["depth"], r["text"]) for r in got] == [
        (1, 1, 5, 1, "q"), (1, 1, 5, 2, "good"), (1, 1, 5, 3, "thanks"),
        (1, 2, 4, 1, "q"), (1, 2, 4, 2, "bad"), (1, 2, 4, 3, "more"), (3, 1, 7, 1, "alone")]


def test_deep_chain(spark):
    n = 70
    got = chat.paths(_tree(spark, [(1, i, i - 1 if i else None, "user", str(i), 1.0) for i in range(n)])).orderBy("depth").collect()
    assert [int(r["text"]) for r in got] == list(range(n)) and [r["depth"] for r in got] == list(range(1, n + 1))


def test_query(spark):
    from compare import compare, duck
    from contactgate.llm.queries import op2_chat_format, oracle_sql
    sf = "/root/testdata/sf0.001"
    df = op2_chat_format(spark, sf)
    assert compare(df, duck(sf), oracle_sql()["op2_chat_format"]) == []
    own = df.where("conv_id = -7").first()
    text = "\\### Assistant: </turn> ok"
    assert (own["n_turns"], own["loss_chars"]) == (2, len(text))
    assert own["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert own["turns_sha256"] == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
