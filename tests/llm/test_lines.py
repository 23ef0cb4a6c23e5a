import hashlib
import random

from loomgraph.llm import line_dedup, queries
from loomgraph.llm.common import Stage

from cases import documents, empty


def model(docs, least):
    """Later copies of every repeated run of ``least`` words, by trying all runs."""
    lines = {d: t.split("\n") for d, t in docs.items() if t is not None}
    size = lambda l: max(1, len(l.encode().split()))
    first, gone = {}, {d: set() for d in lines}
    runs = []
    for d in sorted(lines):
        for a in range(len(lines[d])):
            words = 0
            for b in range(a, min(len(lines[d]), a + 40)):
                words += size(lines[d][b])
                if words >= least:
                    runs.append((tuple(lines[d][a : b + 1]), d, a, b))
    for run, d, a, _ in runs:
        first.setdefault(run, (d, a))
    for run, d, a, b in runs:
        if first[run] != (d, a):
            gone[d].update(range(a, b + 1))
    return {d: "\n".join(l for i, l in enumerate(ls) if i not in gone[d]) for d, ls in lines.items()}


def test_matches_brute_force(spark):
    rng = random.Random(4)
    pool = ["a b c", "d e", "", "f g h i j k", "l", "m n o p"] + [f"only {i} here" for i in range(30)]
    docs = {i: "\n".join(rng.choices(pool[:6] if i % 3 else pool, k=rng.randint(0, 14))) for i in range(60)}
    docs |= {100: "\n".join(["a b c"] * 9), 101: "\n".join(pool[:6] * 3), 102: docs[5], 103: docs[5] + "\nend"}
    df = spark.createDataFrame([(d, t, "x") for d, t in docs.items()], "doc_id long, text string, source string")
    for least in (1, 4, 9):
        got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(df, least).collect()}
        assert got == model(docs, least), least


def test_ranks_are_places_in_the_suffix_array(spark):
    rng = random.Random(6)
    texts = {d: [rng.choice("abc") for _ in range(12)] for d in range(5)}
    rows = [(d, 0, p, bytes([ord(c)]), 1, 1) for d, t in texts.items() for p, c in enumerate(t)]
    df = spark.createDataFrame(rows, "doc long, seg int, pos int, id binary, ahead int, back int")
    out = line_dedup.suffix_ranks(df, 2, Stage(spark, "test")).collect()
    every = {(d, p): "".join(t[p:]) for d, t in texts.items() for p in range(12)}
    for r in out:
        for level, k in (("r0", 1), ("r1", 2), ("r2", 4)):
            own = every[r["doc"], r["pos"]][:k]
            assert r[level] == sum(s[:k] < own for s in every.values())


def test_awkward_cases(spark):
    long_line = "z " * 50_000
    docs = documents(spark, [(20, "one two\n" * 30, None, None), (21, long_line + "\nx", "en", "s"), (22, "y\n" + long_line, "en", "s")])
    out = {(r["doc_id"], r["source"]): r for r in line_dedup.dedup_lines(docs).collect()}
    assert out[1, "s1"]["text"] and out[4, "s1"]["text"] is None and out[4, "s1"]["n_lines"] == 0
    assert out[2, "s2"]["n_removed"] == 1 and out[2, "s2"]["text"] == ""  # rows that repeat a doc_id take part
    assert out[21, "s"]["n_removed"] == 0 and out[22, "s"]["text"] == "y"
    assert set(docs.columns) <= set(line_dedup.dedup_lines(docs).columns)
    assert line_dedup.dedup_lines(empty(spark)).count() == 0


def test_every_row_takes_part(spark, tmp_path):
    passage = " ".join(f"w{i}" for i in range(50))
    rng = random.Random(8)
    pool = ["a b c", "d e", "", "f g h i j k", "l", "m n o p"]
    shard = [(i, "\n".join(rng.choices(pool, k=12))) for i in range(20)]
    rows = [*shard, *shard, (5, passage + "\nfive"), (30, "thirty\n" + passage), (None, passage + "\nnone"), (None, passage + "\nnone"), (None, None), (None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, hashlib.md5((rows[i][1] or "").encode()).hexdigest()))
    for least in (4, 20):
        want = model({n: rows[i][1] for n, i in enumerate(order)}, least)
        want = sorted((str(rows[i][0]), str(want.get(n))) for n, i in enumerate(order))
        got = sorted((str(r["doc_id"]), str(r["text"])) for r in line_dedup.dedup_lines(df, least).collect())
        assert got == want, least
    df.write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.op3_line_dedup(spark, str(tmp_path)).collect()
    assert len(out) == len(rows) and sum(passage in (r["text"] or "") for r in out) == 1


def test_sql_covers_repeated_and_null_ids(spark, tmp_path):
    import duckdb

    passage = " ".join(f"w{i}" for i in range(50))
    rng = random.Random(9)
    pool = ["a b c", "d e", "", "f g h i j k", "l", "m n o p"]
    rows = [(rng.choice([1, 2, 2, 3, 4, None]), "\n".join(rng.choices(pool, k=rng.randint(0, 14)))) for _ in range(60)]
    rows += [(5, passage + "\nfive"), (5, passage), (None, passage), (None, passage), (6, None), (None, None), (7, "")]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = sorted(map(str, con.execute("SELECT doc_id, text, n_lines, n_removed FROM (" + queries.OP3_SQL + ")").fetchall()))
    got = queries.op3_line_dedup(spark, str(tmp_path)).select("doc_id", "text", "n_lines", "n_removed").collect()
    assert sorted(str(tuple(r)) for r in got) == want


def test_maximal_runs(spark):
    """Chains of shortest runs are the longest runs that a document shares, line by line, with the earliest copies."""
    rng = random.Random(10)
    pool = ["a b c", "d e", "f g h i j k", "l", "m n o p"]
    docs = {i: "\n".join(rng.choices(pool, k=rng.randint(3, 12))) for i in range(25)} | {50: "q r s t\nu v w\nx", 51: "zero\nq r s t\nu v w\nx\nlast", 52: "q r s t\nu v w\nx"}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    least = 4
    later = line_dedup.later_runs(df, least, "doc_id")
    lines = {d: t.split("\n") for d, t in docs.items()}
    words = lambda ls: sum(max(1, len(l.split())) for l in ls)
    got = {tuple(r) for r in line_dedup.maximal_runs(later).collect()}
    for doc, start, stop, first, at in got:
        n = stop - start + 1
        assert lines[doc][start : stop + 1] == lines[first][at : at + n] and words(lines[doc][start : stop + 1]) >= least
        assert (first, at) < (doc, start)
    assert (51, 1, 3, 50, 0) in got and (52, 0, 2, 50, 0) in got
    covered = {(d, i) for d, a, b, _, _ in got for i in range(a, b + 1)}
    kept = model(docs, least)
    assert {d: "\n".join(l for i, l in enumerate(ls) if (d, i) not in covered) for d, ls in lines.items()} == kept
