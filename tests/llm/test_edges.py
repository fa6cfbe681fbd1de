"""Empty tables, all-null rows, repeated rows and clashing columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import chat, jaccard, licenses, mixing, neighbours, packing, quality, secrets, toxicity, warc
from strata.llm.queries import tokenizer_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LABELS = "doc_id long, quality int, toxic int"


def labels(spark):
    return spark.createDataFrame([(0, 1, 0), (2, 1, 1)], LABELS)


def runs(spark):
    return {
        "quality": lambda d: quality.clean_lines(d),
        "secrets": lambda d: secrets.report(d),
        "redact": lambda d: secrets.redact(d),
        "mixing": lambda d: mixing.report(d),
        "mix": lambda d: mixing.mix(d),
        "toxicity": lambda d: toxicity.report(d, labels(spark)),
        "clean": lambda d: toxicity.clean(d, labels(spark)),
        "packing": lambda d: packing.report(d, tokenizer_path()),
        "jaccard": lambda d: jaccard.report(d),
        "one_of_each": lambda d: jaccard.one_of_each(d),
        "licenses": lambda d: licenses.identify(d),
    }


def test_empty_tables(spark):
    empty = spark.createDataFrame([], DOCS)
    for name, run in runs(spark).items():
        assert run(empty).count() == 0, name
    assert chat.render(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
    assert neighbours.report(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    assert warc.report(spark, spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_all_null_and_repeated_rows(spark):
    nulls = spark.createDataFrame([(None,) * 5] * 3, DOCS)
    some = spark.createDataFrame([(1, "a b c d e f", "en", "x", 11)] * 4, DOCS)
    want = {"mix": None, "one_of_each": 4}
    for name, run in runs(spark).items():
        n = run(nulls.unionAll(some)).count()
        if name == "packing":
            assert n >= 7
        elif want.get(name, 7) is not None:
            assert n == want.get(name, 7), name
    assert neighbours.report(spark.createDataFrame([(None, None)] * 3, "vec_id long, embedding array<float>")).count() == 0
    assert warc.report(spark, spark.createDataFrame([(None, None, None)] * 3, "page_id long, url string, html string")).count() == 3


def test_clashing_columns(spark):
    taken = ["measured", "n_words", "kept", "cleaned", "tie", "rid", "spans", "found", "score", "cut", "toxic", "digest", "license", "notices",
             "rows_alike", "copies_alike", "row_no", "key", "key_", "n", "group", "class", "size", "owner", "repo", "a.b", "Kept"]
    docs = spark.createDataFrame([(i, f"word{i} " * 12, "en", "x", 5) for i in range(4)], DOCS)
    docs = docs.withColumns({c: F.lit("mine") for c in taken if c != "Kept"})
    for name, run in runs(spark).items():
        got = run(docs)
        assert got.count() >= 4, name
        if name in ("redact", "mix", "clean", "one_of_each"):
            assert got.columns == docs.columns and {r["kept"] for r in got.collect()} == {"mine"}, name
        if name == "quality":
            assert "kept_1" in got.columns and "n_words_1" in got.columns


def test_clashing_columns_of_other_tables(spark):
    mine = lambda df, names: df.withColumns({c: F.lit("mine") for c in names})
    pages = spark.createDataFrame([(i, "u", f"<p>{i}</p>" * 30) for i in range(5)], "page_id long, url string, html string")
    taken = ["key", "digest", "shard", "bin", "range", "parts", "is_page", "target", "payload", "refers_to", "size", "low", "width", "next"]
    got = warc.report(spark, mine(pages, taken))
    assert sorted(r["page_id"] for r in got.collect()) == list(range(5)) and got.columns[0] == "page_id"
    turns = spark.createDataFrame([(c, t, "user", f"t{t}") for c in range(3) for t in range(c + 1)], "conv_id long, turn long, role string, text string")
    taken = ["conv", "pos", "h1", "h2", "next", "length", "part", "line", "lines", "kept", "rendered", "n_turns"]
    got = chat.render(mine(turns, taken))
    assert [(r["conv_id"], r["n_turns"]) for r in got.collect()] == [(2, 3)] and got.columns == ["conv_id", "part", "n_turns", "rendered"]
    vectors = spark.createDataFrame([(100 * i, [float(i), 1.0]) for i in range(4)], "vec_id long, embedding array<float>")
    taken = ["id", "vector", "asks", "qkey", "ids", "r", "score", "rank", "query_id"]
    got = neighbours.report(mine(vectors, taken))
    assert got.count() == 12 and got.columns == ["query_id", "rank", "vec_id", "score"]


def test_very_long_texts(spark):
    """Texts of megabytes go through whole."""
    n = 150_000
    words = " ".join(f"w{i}" for i in range(n))
    texts = [words + " password=Abcdefgh12345", words + ".\nReleased under the MIT License.", "short"]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], DOCS)
    got = {r["doc_id"]: r for r in secrets.report(docs).collect()}
    assert got[0]["spans"] == f"assign:{len(words) + 1}:{len(texts[0])}" and got[1]["spans"] == ""
    clean = {r["doc_id"]: r["text"] for r in secrets.redact(docs).collect()}
    assert clean[0] == words + " " + secrets.PLACEHOLDER and clean[1] == texts[1]
    assert {r["doc_id"]: r["size"] for r in mixing.report(docs).collect()} == {0: n + 1, 1: n + 5, 2: 1}
    notices = {r["doc_id"]: r["notices"] for r in licenses.report(docs).collect()}
    assert notices == {0: "", 1: "MIT notice", 2: ""}
    turns = spark.createDataFrame([(1, 0, "user", words), (1, 1, "user", "b"), (2, 0, "user", words)], "conv_id long, turn long, role string, text string")
    got = chat.render(turns).collect()
    assert [(r["conv_id"], r["n_turns"]) for r in got] == [(1, 2)] and words in got[0]["rendered"]


def test_pipeline_run_of_an_empty_table_and_of_a_long_text(spark, tmp_dir):
    labels(spark).write.parquet(f"{tmp_dir}/labels.parquet")
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_dir}/documents.parquet")
    got = corpus_pipeline.run(spark, tmp_dir)
    assert got.count() == 0 and got.columns[:3] == ["doc_id", "start", "length"]
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, long, "en", "a", len(long)), (2, long, "en", "a", len(long)), (3, "token = 'Abcdef1234567890' and some more words", "en", "a", 1)]
    spark.createDataFrame(rows, DOCS).write.mode("overwrite").parquet(f"{tmp_dir}/documents.parquet")
    got = corpus_pipeline.run(spark, tmp_dir).collect()
    assert {r["doc_id"] for r in got} == {1, 3} and all(r["length"] <= 1024 for r in got)
    whole = {}
    for r in got:
        whole[r["doc_id"]] = whole.get(r["doc_id"], 0) + r["length"]
    copies = {r["doc_id"]: whole[r["doc_id"]] / r["doc_tokens"] for r in got}
    assert all(c == int(c) and c >= 1 for c in copies.values())


def test_pipeline_drops_toxic_documents(spark, tmp_dir):
    """Labels of both classes: held-out toxic texts go, clean ones stay."""
    import random
    import zlib

    rng = random.Random(2)
    rows, marks = [], []
    for i in range(600):
        ws = [f"v{rng.randint(0, 300)}x" for _ in range(rng.randint(20, 60))]
        if i % 4 == 0:
            for _ in range(2):
                ws.insert(rng.randint(0, len(ws)), rng.choice(["zorkle", "zorklet", "vexing"]))
        rows.append((i, " ".join(ws), "en", "ab"[i % 2], 1))
        marks.append((i, 1, int(i % 4 == 0)))
    docs = spark.createDataFrame(rows, DOCS)
    docs.write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame(marks, LABELS).write.parquet(f"{tmp_dir}/labels.parquet")
    left = {r["doc_id"] for r in corpus_pipeline.drop_toxic(spark, docs, tmp_dir).collect()}
    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum(i in left for i in held if i % 4 == 0) <= 2 and sum(i not in left for i in held if i % 4) <= 5


def test_pipeline_stages_on_a_small_table(spark, tmp_dir):
    text = "Then the old man told them a long story about the sea and the moon and the quiet harbour"
    rows = [(0, text, "en", "a", 1), (1, text + " today", "en", "b", 1), (2, None, None, None, None), (3, "", "fr", "b", 0),
            (4, "token = 'Abcdef1234567890' is what the file says and nothing else matters much here", "en", "a", 1)]
    rows += [(10 + i, f"filler number {i} with words of its own kind {i * 7} and {i * 13} more", "en", "ab"[i % 2], 1) for i in range(30)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_dir}/documents.parquet")
    labels(spark).write.parquet(f"{tmp_dir}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_dir}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, tmp_dir)
        seen[name] = docs.collect()
        if name != "packing":
            assert docs.columns == DOCS.replace(" long", "").replace(" string", "").split(", ")
    ids = lambda n: {r["doc_id"] for r in seen[n]}
    assert 1 not in ids("ngram_jaccard_join") and {0, 2, 3, 4} <= ids("ngram_jaccard_join")
    assert [r["text"] for r in seen["secret_scans"] if r["doc_id"] == 4][0].startswith("[SECRET]'")
    got = corpus_pipeline.run(spark, tmp_dir).collect()
    assert sorted((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in got) == sorted(
        (r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in seen["packing"]
    )


def test_pipeline_run_equals_a_plain_pass(spark, tmp_dir):
    import re
    import zlib
    from collections import Counter

    import numpy as np
    from tokenizers import Tokenizer

    text = "Then the old man told them a long story about the sea and the moon and the quiet harbour"
    shared = "AKIA" + "Q" * 16
    rows = [(0, text, "en", "a", 1), (1, text + " today", "en", "b", 1), (2, None, "en", "a", None), (3, "", "fr", "b", 0), (9, text, "en", "c", 1),
            (4, "token = 'Abcdef1234567890' is what the file says and nothing else matters much here", "en", "a", 1)]
    rows += [(5 + i, f"example {shared} number {i} is copied by everyone {i * 3} times {i * 5}", "en", "abc"[i], 1) for i in range(3)]
    rows += [(10 + i, " ".join(f"w{i}x{j}" for j in range(5 + 37 * i)), "en", "abc"[i % 3], 1) for i in range(30)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_dir}/documents.parquet")
    # Labels of one class: nothing is toxic.
    spark.createDataFrame([(r[0], 1, 0) for r in rows], LABELS).write.parquet(f"{tmp_dir}/labels.parquet")

    def shingles(t):
        ws = (t or "").split()
        return {tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set()

    # Smallest id first, so a linked row always meets the one that stays.
    kept = []
    for r in sorted(rows, key=lambda r: r[0]):
        mine = shingles(r[1])
        if not any(mine and 5 * len(mine & s) >= 4 * len(mine | s) for s in (shingles(k[1]) for k in kept)):
            kept.append(r)
    assert {r[0] for r in rows} - {r[0] for r in kept} == {1, 9}
    secret = re.compile(r"token = 'Abcdef1234567890")
    clean = [(r[0], r[1] and secret.sub(secrets.PLACEHOLDER, r[1]), *r[2:]) for r in kept]
    copies = {r["doc_id"]: r["copies"] for r in mixing.report(spark.createDataFrame(clean, DOCS)).collect()}
    assert len(copies) == len(clean) and sum(copies.values()) > len(clean) // 2
    lib = Tokenizer.from_file(tokenizer_path())
    ids = {r[0]: lib.encode(r[1] or "", add_special_tokens=False).ids + [packing.CLOSING_ID] for r in clean}
    want = Counter({(d, i): n for d, n in copies.items() if n for i in range(len(ids[d]))})
    got, places = Counter(), Counter()
    for r in corpus_pipeline.run(spark, tmp_dir).collect():
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(part) == r["length"] and r["doc_tokens"] == len(ids[r["doc_id"]])
        assert r["ids_crc32"] == zlib.crc32(np.array(part, dtype="<u4").tobytes()), r
        got.update((r["doc_id"], r["start"] + i) for i in range(r["length"]))
        places.update((r["sequence_id"], r["offset"] + i) for i in range(r["length"]))
    assert got == want
    assert max(places.values()) == 1 and max(o for _, o in places) < packing.CAPACITY


@pytest.mark.parametrize("sql_only", [True])
def test_every_query_is_registered(sql_only):
    from strata.llm import queries

    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))
    assert set(queries.ORACLES) <= set(queries.QUERIES)


def test_native_operators_run_no_python(spark):
    from strata.llm.queries import QUERIES

    for name in ("op2_line_first_cleaning", "op3_snapshot_collapse", "op4_secret_ownership", "op6_systematic_mix"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "InArrow")), name
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_tokens_of_the_quick_path_equal_the_librarys():
    import numpy as np
    from tokenizers import Tokenizer

    from strata.llm.packing import Encoder

    lib, ours = Tokenizer.from_file(tokenizer_path()), Encoder(tokenizer_path())
    ours_small = Encoder(tokenizer_path())
    texts = ["", " ", "  a  b\n\n c ", "don't we'll I'M 'tis x's", "ÀÖØöøſ ñandú straße", "1 22 333 4a a4", "a_b-c!!! ###", "\t\r\n\x0b\x0c x", "日本 text", "½²", "\x1f y", "<|endoftext|>"]
    for t in texts:
        want = np.asarray(lib.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes()
        assert ours(t) == want == ours_small(t), repr(t)
