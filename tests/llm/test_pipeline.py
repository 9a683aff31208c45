import re
import subprocess
import sys
from pathlib import Path

import brute
import corpus_pipeline as cp
import pytest
import tiktoken

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, __copy int"
ROOT = Path(__file__).resolve().parent.parent.parent


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), 1) for i, t, s in rows], SCHEMA)


A = "the quick brown fox jumps over the lazy dog again and again until night falls over the quiet hills and the stars come out"
B = "an entirely different document that talks about the weather, the sea and the ships that sail on it from port to port"


@pytest.fixture(scope="module")
def rows():
    return [(1, A, "a"), (2, A.upper(), "a"), (3, "intro words. " + A + " closing words here", "b"), (4, B, None), (5, None, "a"),
            (6, "", "b"), (7, "123 456", "b"), (8, B + " and then home", "b"), (4, B, None)]


def test_language_stage(spark, rows):
    got = cp.known_language(spark, _docs(spark, rows), "")
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "__copy"]
    assert sorted(r["doc_id"] for r in got.collect()) == [1, 2, 3, 4, 4, 8]
    assert cp.known_language(spark, _docs(spark, rows).limit(0), "").count() == 0


def test_near_duplicate_stage(spark, rows):
    got = cp.one_of_each_group(spark, _docs(spark, rows), "")
    docs = sorted({(i, t) for i, t, _ in rows}, key=lambda r: r[0])
    fps = [brute.fingerprint(t) for _, t in docs]
    label = brute.components(len(docs), brute.near(fps))
    assert sorted(r["doc_id"] for r in got.collect()) == sorted({docs[k][0] for k in label})
    assert cp.one_of_each_group(spark, _docs(spark, rows).limit(0), "").count() == 0


def test_near_duplicate_stage_keeps_one_of_each_group_whatever_the_ids(spark):
    c, d = "ships leave the harbour at dawn with salt and rope", "seven green apples on the table of an old inn"
    rows = [(None, A, "a"), (None, A.upper(), "b"), (None, B, "a"), (None, c, "a"),     # null ids, three groups
            (5, d, "a"), (None, d.upper(), "a"),                                        # a null id beside a named one
            (7, "one tale of the sea", "a"), (7, "another story of the high mountains", "b"),   # one id, two groups
            (7, None, "a"), (7, "", "b")]
    got = sorted((r["doc_id"] or 0, r["text"] or "") for r in cp.one_of_each_group(spark, _docs(spark, rows), "").collect())
    assert got == sorted([(0, A.upper()), (0, B), (0, c), (5, d), (7, rows[6][1]), (7, rows[7][1]), (7, "")])
    alone = [(1, A, "a"), (2, A.upper(), "a"), (None, A.title(), "a"), (None, B, "a")]
    got = sorted((r["doc_id"] or 0, r["text"]) for r in cp.one_of_each_group(spark, _docs(spark, alone), "").collect())
    assert got == [(0, B), (1, A)]


def test_repeats_stage(spark, rows):
    unique = rows[:8]
    got = {r["doc_id"]: r for r in cp.without_repeats(spark, _docs(spark, unique), "").collect()}
    want = brute.repeats([(i, (t or "").encode()) for i, t, _ in unique])
    for i, t, s in unique:
        assert got[i]["source"] == s and got[i]["text"] == (None if t is None else want[i].decode())
        assert got[i]["n_chars"] == (None if t is None else len(want[i].decode()))
    assert len(got[3]["text"]) < len(rows[2][1])


def test_mixing_stage(spark, rows):
    docs = _docs(spark, rows[:8])
    got = cp.mixed(spark, docs, "")
    assert got.columns == docs.columns
    from contactgate.llm import mixing
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(docs).collect()}
    found = [r["doc_id"] for r in got.collect()]
    assert all(found.count(i) == c for i, c in copies.items())


def test_mixing_stage_takes_each_row_as_decided_whatever_the_ids(spark, monkeypatch):
    from collections import Counter

    from contactgate.llm import mixing
    rows = [(None, f"n{i} " * (1 + i % 7), "a" if i % 3 else "b") for i in range(40)]
    rows += [(7, f"r{i} " * (1 + i % 5), "a") for i in range(20)] + [(8, "same words here", "c")] * 9 + [(9, "x", None), (9, None, "x")]
    docs = _docs(spark, rows)
    monkeypatch.setattr(cp, "BATCH", 4)
    want, words = Counter(), Counter()
    for r in mixing.mix(docs).collect():
        want[r["doc_id"], r["source"], r["size"]] += r["copies"]
        words[r["source"]] += r["taken"]
    got, taken = Counter(), Counter()
    for r in cp.mixed(spark, docs, "").collect():
        got[r["doc_id"], r["source"], len(r["text"].split())] += 1
        taken[r["source"]] += len(r["text"].split())
    assert got == +want and taken == +words


def test_bpe_stage(spark, rows):
    import base64

    import public_tokenizers
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {i: t for i, t, _ in rows}
    for r in cp.encoded(spark, _docs(spark, rows), "").collect():
        assert r["reads_back"] and r["ids"] == reference.encode_ordinary(texts[r["doc_id"]] or "")


def test_run(spark):
    got = cp.run(spark, "/root/testdata/sf0.001").collect()
    assert got and all(r["reads_back"] for r in got) and cp.ORACLE_SQL is None
    assert [name for name, _ in cp.STAGES] == ["language ID", "SimHash near-dedup", "suffix-array dedup", "mixing to target weights", "byte-level BPE"]


def _stays(texts, length=100):
    """Texts without the characters that have a byte in a window that starts earlier too."""
    seen, out = set(), {}
    for i, text in sorted(texts.items()):
        raw = (text or "").encode()
        gone = [False] * len(raw)
        for p in range(len(raw) - length + 1):
            if raw[p:p + length] in seen:
                gone[p:p + length] = [True] * length
            seen.add(raw[p:p + length])
        kept, at = [], 0
        for c in text or "":
            n = len(c.encode())
            if not any(gone[at:at + n]):
                kept.append(c)
            at += n
        out[i] = None if text is None else "".join(kept)
    return out


def test_run_equals_the_plain_versions_chained(spark):
    """The whole pipeline against one plain version after the other (the language model is
    the fitted one, its predictions are made by hand)."""
    import base64
    from collections import Counter

    import duckdb
    import pandas as pd
    import public_tokenizers

    from contactgate.llm import language, mixing
    sf = "/root/testdata/sf0.001"
    frame = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r["doc_id"]: r for r in frame.collect()}
    model = language.fit(frame)
    texts = {}
    for i, r in rows.items():
        lang, score = brute.language(model, r["text"], language.MULTIPLIERS)
        if lang != language.UNKNOWN and score >= cp.MIN_POSTERIOR:
            texts[i] = r["text"]
    assert 0 < len(texts) <= len(rows)
    ids = sorted(texts)
    label = brute.components(len(ids), brute.near([brute.fingerprint(texts[i]) for i in ids]))
    texts = {ids[k]: texts[ids[k]] for k in set(label)}
    assert len(texts) < len(ids)
    texts = _stays(texts)
    con = duckdb.connect()
    con.register("documents", pd.DataFrame([{"doc_id": i, "source": rows[i]["source"], "text": t} for i, t in texts.items()]))
    copies = {i: taken // size if size else 0 for i, size, _, _, taken in con.execute(mixing.SQL).fetchall()}
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for i, n in copies.items():
        want[i, rows[i]["lang"], rows[i]["source"], tuple(reference.encode_ordinary(texts[i] or ""))] += n
    got = Counter((r["doc_id"], r["lang"], r["source"], tuple(r["ids"])) for r in cp.run(spark, sf).collect())
    assert got == +want


def test_stages_take_any_column_names(spark, rows):
    """Columns named like the ones a stage makes, and rows that tie."""
    docs = _docs(spark, rows).selectExpr("*", "1 AS language_found", "2 AS Posterior_Found", "'x' AS component", "doc_id AS fp")
    assert sorted(r["doc_id"] for r in cp.known_language(spark, docs, "").collect()) == [1, 2, 3, 4, 4, 8]
    once = cp.one_of_each_group(spark, docs, "")
    assert once.columns == docs.columns and sorted(r["doc_id"] for r in once.collect()) == sorted(
        r["doc_id"] for r in cp.one_of_each_group(spark, _docs(spark, rows), "").collect())


def test_all_is_registered():
    import __spark_entry__ as entry
    names = set(entry.queries())
    assert "pipeline" in names
    assert {f"op{i}" for i in range(1, 14)} == {n.split("_")[0] for n in names if n.startswith("op")}
    assert set(entry.oracle_sql()) <= names


def test_nothing_else_imports_this_folder():
    for path in (ROOT / "contactgate").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert not re.search(r"\bllm\b", path.read_text())


def test_entry_works_without_the_folder(tmp_path):
    import shutil
    shutil.copytree(ROOT / "contactgate", tmp_path / "contactgate", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'phone_state' in q and not any(n.startswith('op') or n == 'pipeline' for n in q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": ":".join(p for p in sys.path if "site-packages" in p)})
