"""Manifest, line field and vector codes against brute-force versions."""

import hashlib
import itertools
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from dimforge.llm import codes, crf, manifest


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_leaf(values):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def brute_tree(nodes):
    """(root, proofs as lists of (before, after)) of digests."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i:i + 8] for i in range(0, len(nodes), 8)]
        for leaf, i in enumerate(at):
            run, place = runs[i // 8], i % 8
            proofs[leaf].append(("".join(run[:place]), "".join(run[place + 1:])))
            at[leaf] = i // 8
        nodes = [digest(*r) for r in runs]
    return nodes[0], proofs


def brute_manifest(rows):
    """rows of (doc_id, source, lang, n_chars, text) -> sorted results."""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    groups = [sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, brute_leaf(r))) for lang in langs]
    subs = [brute_tree([brute_leaf(r) for r in g]) for g in groups]
    root, tops = brute_tree([s for s, _ in subs])
    out = []
    for g, (sub, proofs), top in zip(groups, subs, tops):
        for r, proof in zip(g, proofs):
            steps = proof + top
            out.append((r[0], brute_leaf(r), sub, root, digest(*(b + a for b, a in steps))))
    return sorted(map(str, out))


def manifest_rows(n, langs):
    rng = random.Random(n)
    rows = [(i, f"s{i % 3}", langs[i % len(langs)] if i % 3 else langs[0], i, "Text É %d %s" % (i, "x" * rng.randrange(50)))
            for i in range(n)]
    return rows


@pytest.mark.parametrize("rows", [
    manifest_rows(1, ["en"]), manifest_rows(8, ["en"]), manifest_rows(9, ["en"]), manifest_rows(700, ["en", "de", None, "fr", "é"]),
    manifest_rows(70, ["l%d" % i for i in range(70)]),
    [(None, None, None, None, None)] * 3 + [(5, "a", "x", 1, "t"), (5, "a", "x", 1, "t"), (5, "b", "x", 1, ""), (5, "a", None, 1, "t" * 100000)],
])
def test_manifest_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    df = df.withColumn("leaf", F.lit("clash")).withColumn("grp", F.lit(1)).withColumn("steps", F.lit("clash")).repartition(3)
    claim = manifest.leaf(*map(F.col, ("doc_id", "source", "lang", "n_chars")), F.when(F.col("doc_id") == 5, F.lit("other")).otherwise(F.col("text")))
    found = manifest.manifest(df, claim=claim).select(
        "doc_id", "leaf", "subroot", "root", manifest.proof_digest(F.col("steps")).alias("proof"),
        manifest.folded_root(F.col("steps"), F.col("claim")).alias("folded")).collect()
    assert sorted(str(tuple(r[:5])) for r in found) == brute_manifest(rows)
    assert all((r["folded"] == r["root"]) == (r["doc_id"] != 5) for r in found)


def test_hot_segments_are_salted(spark, monkeypatch):
    """A long chain with many pointers to one node, under few salts."""
    monkeypatch.setattr(manifest, "FAN", 2)
    monkeypatch.setattr(manifest, "MAX_SALTS", 4)
    rows = manifest_rows(300, ["en"])
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    found = manifest.manifest(df).select("doc_id", "root", manifest.folded_root(F.col("steps"), F.col("leaf")).alias("folded"),
                                         F.size("steps").alias("n")).collect()
    assert len(found) == 300 and all(r["folded"] == r["root"] for r in found)
    assert {r["n"] for r in found} == {9}


def brute_codes(rows):
    """rows of (vec_id, vector, label) -> sorted results and codebooks."""
    kept = [(i, [math.floor(4096 * float(np.float32(x))) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    m = len(kept[0][1]) // 8

    def cut(v, p):
        return v[p * m:(p + 1) * m]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))

    books = [[cut(v, p) for _, v, _ in kept[:16]] for p in range(8)]
    for _ in range(6):
        for p in range(8):
            held = {}
            for _, v, _ in kept:
                held.setdefault(near(cut(v, p), books[p])[1], []).append(cut(v, p))
            for e, xs in held.items():
                books[p][e] = [sum(c) // len(xs) for c in zip(*xs)]
    out, totals = [], {}
    for i, v, label in kept:
        found = [near(cut(v, p), books[p]) for p in range(8)]
        error = sum(d for d, _ in found)
        totals[label] = totals.get(label, 0) + error
        out.append((i, "".join(f"{e:02x}" for _, e in found), error, label))
    return sorted(str((i, c, e, totals[label])) for i, c, e, label in out), books


def vector_rows(n, seed=0):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(0, 0.2, 16).astype(np.float32).tolist(), int(i % 3) if i % 4 else None) for i in range(n)]
    return rows


@pytest.mark.parametrize("rows", [
    vector_rows(400), vector_rows(5),
    # Ties, repeats, dropped rows, null ids and a vector that half of the rows hold.
    vector_rows(60) + [(100 + i, [0.5] * 16, 1) for i in range(200)] + [(3, [0.25] * 16, 1)] * 3
    + [(None, [0.0] * 16, None), (901, None, 1), (902, [None] + [0.0] * 15, 1), (903, [float("nan")] * 16, 1), (904, [float("inf")] + [0.0] * 15, 2)],
])
def test_codes_match_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("code", F.lit("clash")).repartition(4)
    found, books = codes.compress(df)
    want, brute = brute_codes(rows)
    assert sorted(str(tuple(r)) for r in found.collect()) == want
    assert books.tolist() == brute
    assert codes.books_digest(books) == hashlib.sha256(",".join(str(x) for b in brute for e in b for x in e).encode()).hexdigest()


def test_residents_are_summed_without_exchange(spark):
    rows = vector_rows(200)
    kept = spark.createDataFrame(rows, "vec_id long, v0 array<float>, label int").select(
        F.col("vec_id").alias("row"), codes.whole(F.col("v0")).alias("v"))
    first = np.array([r["v"] for r in kept.orderBy("row").limit(16).collect()]).reshape(16, 8, 2).transpose(1, 0, 2)
    parts = kept.select(F.lit(0).alias("salt"), F.posexplode("v").alias("position", "c0")).select(
        F.floor(F.col("position") / 2).cast("int").alias("position"), F.lit(-1).alias("owner"), "salt", "c0", F.col("c0").alias("c1"))
    here = codes.Members(spark, 8)
    residents = here.send(codes._assigned(parts, first))
    owned = residents.groupBy("position", "owner", "salt").agg(F.sum("c0"))
    plan = owned._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    # Only parts that change entry are sent.
    there = codes.Members(spark, 8)
    again = there.settle(codes._assigned(residents, first))
    assert spark.read.parquet(there.path).filter("moved = 'true'").count() == 0 and again.count() == residents.count()
    here.drop(), there.drop()


def test_codes_reject_what_they_cannot_cut(spark):
    with pytest.raises(ValueError):
        codes.compress(spark.createDataFrame([(1, [0.5] * 9, 1)], "vec_id long, embedding array<float>, label int"))


def test_marginals_match_enumeration():
    rng = np.random.default_rng(0)
    for n in range(1, 7):
        field = crf.LineField(np.zeros((3, crf.FIGURES)), rng.normal(0, 1, (2, 2)))
        odds = rng.normal(0, 2, n)
        total, good = 0.0, np.zeros(n)
        for y in itertools.product((0, 1), repeat=n):
            w = math.exp(sum(o for o, k in zip(odds, y) if k) + sum(field.moves[a, b] for a, b in zip(y, y[1:])))
            total += w
            good += w * np.array(y)
        assert np.allclose(field.marginals(odds.tolist()), good / total)


def test_gradients_match_differences():
    rng = np.random.default_rng(1)
    lengths = np.array([1, 4, 2])
    x = rng.integers(0, 2, (7, 3 * crf.FIGURES)).astype(np.float64)
    y, scale = np.array([0, 1, 1]), np.array([0.5, 0.3, 0.2])
    w, moves = rng.normal(0, 0.3, (3, crf.FIGURES)), rng.normal(0, 0.5, (2, 2))
    _, dw, dm = crf._objective(x, y, lengths, scale, w, moves)
    for values, grad, at in ((w, dw, (0, 3)), (w, dw, (1, 10)), (w, dw, (2, 40)), (moves, dm, (0, 1)), (moves, dm, (1, 1)), (moves, dm, (0, 0))):
        kept = values[at]
        values[at] = kept + 1e-5
        up = crf._objective(x, y, lengths, scale, w, moves)[0]
        values[at] = kept - 1e-5
        down = crf._objective(x, y, lengths, scale, w, moves)[0]
        values[at] = kept
        assert abs((up - down) / 2e-5 - grad[at]) < 1e-6


def test_line_figures():
    figures, sizes, chains = crf.line_figures(["", "Ab cd.\n\n  \nXX XX 12 #|", "\n", "a a b a\na a b a"])
    assert chains.tolist() == [0, 2, 0, 2] and sizes.tolist() == [5, 8, 5 - 1, 4]
    names = [k for k in ("upper", "digit", "stop", "mark", "symbol", "beyond", "again", "near", "shouted") for _ in crf.SHARES]
    share = {k: [i + 1 for i, n in enumerate(names) if n == k] for k in set(names)}
    above = lambda line, k: int(figures[line, share[k]].sum())
    assert above(0, "upper") == sum(1 / 5 > s for s in crf.SHARES) and above(0, "stop") == sum(1 / 5 > s for s in crf.SHARES)
    assert above(1, "upper") == sum(4 / 8 > s for s in crf.SHARES) and above(1, "again") == sum(1 / 4 > s for s in crf.SHARES)
    assert above(1, "shouted") == sum(2 / 4 > s for s in crf.SHARES) and above(1, "symbol") == sum(2 / 8 > s for s in crf.SHARES)
    assert above(2, "again") == sum(1 / 4 > s for s in crf.SHARES) and above(2, "near") == sum(1 / 4 > s for s in crf.SHARES)
    assert figures[:, -1].tolist() == [0, 0, 0, 1]


def test_long_texts_are_read_in_pieces(monkeypatch):
    rng = random.Random(4)
    texts = ["\n".join(" ".join(rng.choices(["alpha", "BETA", "12", "é", "x."], k=rng.randrange(0, 30))) for _ in range(rng.randrange(1, 40)))
             for _ in range(30)] + ["", "w" * 700, " ".join("ab" for _ in range(400)), "\n" * 300 + "end"]
    want = crf.line_figures(texts)
    monkeypatch.setattr(crf, "PIECE", 256)
    got = crf.line_figures(texts)
    assert (got[1] == want[1]).all() and (got[2] == want[2]).all()
    # A word longer than a piece is cut; all other lines have the same figures.
    long_word = int(np.cumsum(want[2])[31] - 1)
    same = np.arange(len(want[0])) != long_word
    assert (got[0][same] == want[0][same]).all()


def test_quality_score_is_the_same_in_every_batch():
    rng, draw = random.Random(1), np.random.default_rng(2)
    field = crf.LineField(draw.normal(size=(3, crf.FIGURES)), draw.normal(size=(2, 2)))
    texts = ["\n".join(" ".join(rng.choices(["alpha", "BETA", "12", "x."], k=rng.randrange(0, 30)))
                       for _ in range(rng.randrange(1, 40))) for _ in range(200)] + ["", "## AA ##\nBB || BB 0"] * 3
    assert field.scores(texts) == [field.scores([t])[0] for t in texts]


def test_quality_learns_and_holds_out(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    labelled = docs.join(labels.select("doc_id"), "doc_id", "left_semi")
    rows = crf.classify(labelled, labels).join(labels, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == r["quality"] for r in held) / len(held) >= 0.97
    clean = [r for r in held if r["quality"] == 1]
    assert sum(r["predicted"] for r in clean) / len(clean) >= 0.98


def test_quality_edges(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(None, 1), (3, None), (4, 7), (5, 0), (5, 0)], "doc_id long, quality int")
    text = {0: "## AA AA AA ##\nBB BB || BB", 1: "A calm line of words.\nAnother one follows it."}
    rows = [(i, f"{text[i % 2]} {i}", "x", "y") for i in range(200)]
    rows += [(None, None, "x", "y"), (301, "", "x", "y"), (302, " \n ", "x", "y"), (303, "word\n" * 20000, "x", "y"), rows[0], rows[0]]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string, quality string")
    got = crf.classify(df, labels).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], set()).add((r["score"], r["predicted"], r["held_out"]))
    assert all(len(v) == 1 for v in by.values())
    assert next(iter(by[None]))[0] == next(iter(by[301]))[0] == next(iter(by[302]))[0] == 0.0
    assert [next(iter(by[i]))[1] for i in range(200)] == [i % 2 for i in range(200)]
    nothing = crf.classify(df, labels.filter("false")).collect()
    assert {r["score"] for r in nothing} == {0.0, 0.5}
