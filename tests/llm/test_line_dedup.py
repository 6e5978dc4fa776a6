import hashlib
import random
import time

from pyspark.sql import functions as F

from punctual.llm import line_dedup


def key(line):
    bare = line.strip("\x20\x09\x0a\x0b\x0c\x0d")
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in bare)


def brute(rows, min_chars=40, min_docs=5):
    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars and doc is not None:
                holders.setdefault(key(line), set()).add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [
            x for x in lines if len(holders.get(key(x), ())) < min_docs or max(holders[key(x)]) == doc
        ]
        sha = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        out.append((doc, len(lines), len(lines) - len(kept), sha))
    return sorted(out, key=repr)


LONG = "This Line Is Shared By Ever So Many Documents Here"
ACCENTS = "É" * 39 + "X"


def table():
    rng = random.Random(2)
    pool = [
        LONG, LONG.lower() + " \t", "\x0b" + LONG.upper() + "\r", ACCENTS, ACCENTS.lower(), "é" * 39 + "X",
        "short", "", "   ", "x" * 39, "y" * 40, " " + "z" * 40,
    ]
    rows = [(i, "\n".join(rng.choices(pool, k=rng.randrange(1, 12)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (None, LONG), (None, None)]
    rows += [(103, f"a\n{LONG}\nb\n{LONG}")] * 2 + [(103, f"{LONG}\nother")]
    return rows + [(104, "w " * 60_000 + "\n" + LONG), (1, LONG + "\nagain")]


def test_matches_brute_force(spark):
    rows = table()
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = sorted(map(tuple, line_dedup.op5_line_dedup(df).collect()), key=repr)
    assert got == brute(rows)


def test_limits_and_clashing_columns(spark):
    rows = table()
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    df = df.withColumn("N_lines", F.lit("x")).withColumn("line", F.lit(1))
    done = line_dedup.dedup_lines(df, min_chars=5, min_docs=2)
    assert done.columns == ["doc_id", "text", "line", "n_lines", "n_dropped"]
    sha = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    got = done.select("doc_id", "n_lines", "n_dropped", sha.alias("s")).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, 5, 2)
    assert done.where("doc_id = 100").first().text is None
    assert line_dedup.op5_line_dedup(df.where("false")).collect() == []


def test_texts_of_very_many_shared_lines(spark):
    lines = [f"line {i} is the same in all of these long documents" for i in range(60_000)]
    rows = [(doc, "\n".join([*lines, f"own line {doc}"])) for doc in range(6)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    begin = time.perf_counter()
    got = sorted(map(tuple, line_dedup.op5_line_dedup(df).collect()))
    assert time.perf_counter() - begin < 30  # 64 s when each line was looked up in a list
    assert got == brute(rows)
