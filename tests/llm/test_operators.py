"""Operators of dimforge.llm against brute-force versions on small tables."""

import random
import re
import struct
import zlib

import numpy as np
import pytest
import public_tokenizers
import xxhash
from pyspark.sql import functions as F

from dimforge.llm import (blocks, bytelang, codes, components, crf, licences, manifest, packing, pieces, quality, ring,
                          simhash, sphere, urlrules)

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, kept string, fp string, root string, "
          "node string, key string, h string, shard string, k1 string, u string, v string, t string, id string, "
          "rank string, line string, sig string, n string, part string, open string, start string")


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def edge_rows():
    """Nulls, empty and long texts, repeats, ties, null and equal ids."""
    rng = random.Random(5)
    long_text = "\n".join(prose(rng, 12) for _ in range(3000))
    body = [prose(rng, 60) + "\nFooter line 12 of the site\n" + prose(rng, 30) for _ in range(40)]
    texts = [None, "", " ", "\n\n", "one", "123 456 !!", "a b c d", "A  b\tC\nd", long_text, long_text, body[0], body[0],
             body[1] + " tail", "Zażółć gęślą jaźń 漢字 ▁ ok", *body]
    rows = [(i, t, ("en", "de", None)[i % 3], "src%d" % (i % 2) if i % 5 else None, len(t or "")) for i, t in enumerate(texts)]
    rows += [(None, "null id text " + prose(rng, 20), "en", None, 5), (None, None, None, None, None), rows[12], rows[12],
             (12, "same id, other text", "en", "src0", 3)]
    return [(*r, *["x"] * 19) for r in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_empty_tables(spark, empty):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    for df in (quality.line_rules(empty), urlrules.apply_url_rules(pages, [urlrules.site_rule("net/", "block")]),
               licences.scan_licences(empty), blocks.extract_main_text(pages), simhash.simhash_components(empty),
               packing.pack(empty, BPE), sphere.embedding_components(vectors), bytelang.identify(empty),
               pieces.encode_texts(empty, PIECES), ring.shard(empty, 4), quality.apply_line_rules(empty),
               simhash.drop_near_duplicates(empty), bytelang.drop_unidentified(empty), manifest.manifest(empty),
               crf.classify(empty, spark.createDataFrame([], "doc_id long, quality int")),
               codes.compress(vectors.selectExpr("*", "1 AS label"))[0]):
        assert df.collect() == []


def test_components_match_union_find(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(7, 1000 + i) for i in range(50)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = dict(components.components(spark.createDataFrame(links, "u long, v long")).collect())
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}


def brute_profile(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    wins = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    hit = {j for i, w in enumerate(wins) if wins.count(w) > 1 for j in range(i, i + 5)}
    lines = [ln for ln in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", ln)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for w in words for c in w),
            sum(ln in lines[:i] for i, ln in enumerate(lines)), len(hit))


def test_quality_base_figures(docs):
    got = quality.line_rules(docs)
    assert got.count() == docs.count()
    joined = docs.filter("doc_id is not null and length(text) < 5000 or text is null").select("doc_id", "text")
    want = sorted((d if d is not None else -1, *brute_profile(t)) for d, t in joined.collect())
    mine = sorted(tuple(-1 if x is None else x for x in r[:6]) for r in got.collect() if r["n_words"] < 3000)
    assert [w for w in want if w[0] >= 0] == [m for m in mine if m[0] >= 0]
    for r in got.collect():
        failed = r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])


def test_common_lines_go_but_copies_stay(spark):
    rng = random.Random(2)
    own = [prose(rng, 40) for _ in range(30)]
    rows = [(i, f"{t}\nShared footer {i + 10}", "a") for i, t in enumerate(own)]
    copy = "\n".join(prose(rng, 15) for _ in range(6))
    rows += [(100 + i, copy + (f"\nextra {i}" if i % 9 == 0 else ""), "a") for i in range(60)]
    rows += [(200, "Shared footer 77\nfew words of its own here and then no more at all", "a")]
    rows += [(201, "Shared footer 21\nShared footer 22\nShared footer 23\nShared footer 24\nnew words", "a")]
    rows += [(202, "Shared footer 77\nhere the host has no other page that holds this line at all", "b")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in quality.line_rules(df).collect()}
    assert all(got[i]["removed_words"] == 3 and got[i]["kept"] for i in range(30))
    assert all(got[100 + i]["removed_words"] == 0 and got[100 + i]["kept"] for i in range(60))
    assert got[200]["removed_words"] == 3 and got[200]["kept"] and not got[201]["kept"]
    assert got[202]["removed_words"] == 0 and got[202]["kept"]
    kept = {r["doc_id"]: r["text"] for r in quality.apply_line_rules(df).collect()}
    assert kept[3] == own[3] and kept[101] == copy and 201 not in kept and len(kept) == 92


def test_copies_and_boilerplate_do_not_keep_a_line(spark):
    rng = random.Random(7)
    names = ["w%d" % i for i in range(3000)]

    def words(n):
        return " ".join(rng.choices(names, k=n))

    # A footer in 15 documents and in 40 copies of one more.
    rows = [(f"{words(40)}\nfooter of the copied", "a") for _ in range(15)]
    rows += [(f"{words(40)}\nfooter of the copied", "a")] * 40
    # Hosts whose documents are mostly boilerplate.
    for host in range(12):
        shared = words(60)
        rows += [(f"{words(20)}\n{shared}", f"b{host}") for _ in range(40)]
    # Near copies stay: each has two words of its own.
    body = "\n".join(words(20) for _ in range(8))
    rows += [(body.replace("\n", f" x{i}\n", 1), "c") for i in range(60)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, source string")
    removed = {r["doc_id"]: r["removed_words"] for r in quality.line_rules(df).collect()}
    assert [removed[i] for i in range(len(rows))] == [4] * 55 + [60] * 480 + [0] * 60


def template_rows():
    """Template pages at several ratios of shared to own words, near copies,
    exact copies, short rests, null hosts."""
    rng = random.Random(17)
    names = ["w%d" % i for i in range(5000)]

    def words(n):
        return " ".join(rng.choices(names, k=n))

    rows = []
    for host, (shared, own) in enumerate(((100, 20), (200, 20), (200, 10), (300, 15))):
        foot = words(shared)
        rows += [(f"{words(own)}\n{foot}", f"t{host}") for _ in range(50)]
    body = [words(60) for _ in range(4)]
    for i in range(80):  # four words of each copy are others, in two lines
        text = [ln.split() for ln in body]
        for line in rng.sample(range(4), 2):
            for at in rng.sample(range(60), 2):
                text[line][at] = f"x{i}"
        rows.append(("\n".join(map(" ".join, text)), "near"))
    rows += [(f"{words(12)}\nthe footer of all", None) for _ in range(14)] + [(f"{words(12)}\nthe footer of all", None)] * 9
    rows += [(f"{words(4)}\na title that too few words follow", "short") for _ in range(30)]
    return [(i, t, h) for i, (t, h) in enumerate(rows)]


def test_template_pages_are_distinct_and_near_copies_are_not(spark):
    rows = template_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    removed = {r["doc_id"]: r["removed_words"] for r in quality.line_rules(df).collect()}
    for i, _, host in rows:
        want = {"t0": 100, "t1": 200, "t2": 200, "t3": 300, "near": 0, None: 4, "short": 0}[host]
        assert removed[i] == want, (i, host)
    kept = quality.apply_line_rules(df.filter("source = 'near'"))
    assert kept.count() == 80 and simhash.drop_near_duplicates(kept).count() >= 1


def test_line_rule_sql_states_the_same_rule(spark):
    import duckdb
    import pyarrow as pa
    from dimforge.llm.queries import OP1_SQL
    rows = template_rows() + [(1000, None, "a"), (1001, "", None), (1002, " \n\n ", "t0")]
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed_words"]
    got = quality.line_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).select(cols)
    con = duckdb.connect()
    con.register("documents", pa.table({k: [r[i] for r in rows] for i, k in enumerate(("doc_id", "text", "source"))}))
    assert sorted(map(tuple, got.collect())) == sorted(con.execute(f"SELECT {', '.join(cols)} FROM ({OP1_SQL})").fetchall())


def test_stages_keep_columns_that_clash(spark):
    rng = random.Random(3)
    names = ("k1", "k2", "gone", "found", "__k1", "__k2", "__gone", "__found", "row", "lines", "candidates", "fp")
    rows = [(i, prose(rng, 40), "en", "s", 1, *names) for i in range(12)] * 2 + [(None, None, None, None, None, *names)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                               + ", ".join(f"{n} string" for n in names))
    for out, n in ((bytelang.drop_unidentified(df), 24), (quality.apply_line_rules(df), 24), (simhash.drop_near_duplicates(df), 13)):
        got = out.collect()
        assert out.columns == df.columns and len(got) == n
        assert all(tuple(r[-len(names):]) == names for r in got)


def test_line_limit_counts_distinct_documents(spark):
    rng = random.Random(9)
    names = ["w%d" % i for i in range(3000)]

    def words(n):
        return " ".join(rng.choices(names, k=n))

    rows = [f"{words(40)}\nline of fifteen documents" for _ in range(15)] + [words(40)] * 2000
    df = spark.createDataFrame([(i, t, "a") for i, t in enumerate(rows)], "doc_id long, text string, source string")
    assert quality.line_rules(df).filter("removed_words = 4").count() == 15
    rows = [f"{words(40)}\nline of fifteen documents" for _ in range(15)] + [words(40) for _ in range(100)]
    df = spark.createDataFrame([(i, t, "a") for i, t in enumerate(rows)], "doc_id long, text string, source string")
    assert quality.line_rules(df, share=0.5).filter("removed_words > 0").count() == 0
    assert quality.line_rules(df, share=0.5, max_docs=14).filter("removed_words = 4").count() == 15


def test_url_rules_match_brute_force(spark):
    rng = random.Random(3)
    hosts = ["example.net", "a.example.net", "EXAMPLE.com", "x.org", "org", "net", ".net", "spam.example", "badnet", "a.net:80"]
    paths = ["", "/", "/en/", "/en", "/de/x", "/fr/1", "/ads/x", "/x?ads/", "/en/#/ads/"]
    urls = [None, "", "no scheme", "http://", "://net/", *(f"http://{h}{p}" for h in hosts for p in paths)]
    rows = [(i, u, "clash") for i, u in enumerate(urls)] + [(3, urls[3], "clash"), (None, "http://b.net/", "z")]
    rules = [urlrules.site_rule("net/", "block"), urlrules.site_rule("example.net/en/", "allow"),
             urlrules.Rule("ads", "/ads/", "block"), urlrules.Rule("loose", "*spam*", "block", 3),
             urlrules.Rule("end", "/de/x|", "block", 2)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "page_id long, url string, host string")

    def brute(u):
        after = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.match(r"[^/?#]*", after).group()
        target = host.lower() + after[len(host):]
        fits = [r for r in rules if re.search(urlrules.rule_regex(r.pattern).replace(r"\z", r"\Z"), target)]
        best = max(fits, key=lambda r: r.priority, default=None)
        return best and best.name

    got = urlrules.apply_url_rules(df, rules)
    assert sorted((str(r["page_id"]), r["rule"] or "") for r in got.collect()) == \
        sorted((str(p), brute(u) or "") for p, u, _ in rows)
    assert urlrules.apply_url_rules(df, []).filter("rule is not null").count() == 0
    assert urlrules.rule_tokens("||spam-farm.*x/ad^") == ["ad", "farm", "spam"]


def test_licences(spark):
    mit = licences.TEXTS[0][1]
    texts = [mit, "Copyright (c) 2021 Jane\n\n" + mit.upper().replace("\n", "\n\n") + "  ", mit + " more", None, "",
             "words\nLICENCED UNDER the  Apache-Licence, version 2.0!\nwords", "Released under the MIT License"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(0, mit, "y")],
                               "doc_id long, text string, license string")
    got = {r["doc_id"]: (r["license"], r["notices"]) for r in licences.scan_licences(df).collect()}
    assert got[0] == ("MIT", []) and got[1] == ("MIT", []) and got[2] == (None, [])
    assert got[3] == got[4] == (None, []) and got[5] == (None, ["Apache-2.0"]) and got[6][1] == ["MIT"]


def test_main_text():
    tree = blocks.trained_tree()
    table = blocks.labelled_table()
    assert all(blocks.decide(tree, tuple(r[:-1])) == bool(r[-1]) for r in table)
    page = ("<html><head><title>T</title><script>var a='</p>';</script></head><body><header>Site</header><nav><a href=x>Home</a>"
            "</nav><div class='ad'>Buy now</div><main><article><h1>Head &amp; tail</h1><p>One<br>two&nbsp;<b>three</b>"
            "<p>Read <a href=y>this</a> next.<div id=cookie-notice>We use cookies</div><form>Mail <input></form></article>"
            "<section class=comments><p>Nice post, very long comment of a reader here</p></section></main>"
            "<aside>Side</aside><footer>&copy; me</footer></body>")
    assert blocks.main_text(page, tree) == "Head & tail\nOne two three\nRead this next."
    assert [blocks.main_text(p, tree) for p in (None, "", "<p", "<!-- x", "<script>a")] == [""] * 5


def test_neighbours_decide_where_no_names_do():
    tree = blocks.trained_tree()
    prose, menu = "<p>" + "word " * 50 + "</p>", "<p><a href=x>Home page</a></p>"
    for own in ("Eight words that stand between two other blocks.", "Twelve words that may be one more line of some article or not."):
        line = f"<p>{own}</p>"
        assert own in blocks.main_text(prose + line + prose, tree)
        assert own not in blocks.main_text(menu + line + menu, tree)

    def used(t):
        return set() if isinstance(t, int) else {blocks.FEATURES[t[0]]} | used(t[2]) | used(t[3])

    assert {"words_before", "words_after", "density_before"} <= used(tree)


def test_compound_names_do_not_lose_the_article():
    tree = blocks.trained_tree()
    story = "<h1>Head of the story told here</h1><p>" + "word " * 30 + "</p>"
    want = "Head of the story told here\n" + ("word " * 30).strip()
    for page in (f"<body class='no-sidebar'><article>{story}</article></body>",
                 f"<body class='left-sidebar'><article>{story}</article></body>",
                 f"<div class='has-sidebar'><article>{story}</article></div>",
                 f"<article class='post related-post'>{story}</article>", f"<main id='search-content'>{story}</main>"):
        assert blocks.main_text(page, tree) == want
        around = page.replace(story, f"<div class='cookie-notice'>{story}</div>{story}<div class=sidebar-box>{story}</div>")
        assert blocks.main_text(around, tree) == want
    assert blocks.main_text(f"<article class='comment'>{story}</article>", tree) == ""


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    grams = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_fingerprints_and_components(docs):
    rows = simhash.simhash_components(docs).collect()
    pairs = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    fps = [brute_fingerprint(t) for _, t in pairs]
    assert sorted((str(r["doc_id"]), r["fp"] % 2**64) for r in rows) == sorted((str(d), f) for (d, _), f in zip(pairs, fps))
    group = list(range(len(fps)))
    for _ in fps:
        for i, a in enumerate(fps):
            group[i] = min(group[j] for j, b in enumerate(fps) if (a ^ b).bit_count() <= 4)
    want = {}
    for (d, _), g in zip(pairs, group):
        want.setdefault(g, []).append(d)
    head = {g: min((d for d in ids if d is not None), default=None) for g, ids in want.items()}
    assert sorted(str((r["doc_id"], r["component_id"])) for r in rows) == \
        sorted(str((d, head[g])) for (d, _), g in zip(pairs, group))
    left = simhash.drop_near_duplicates(docs)
    assert left.columns == docs.columns and left.count() == len(want)


def test_splits_of_the_fingerprint_fetch_every_near_pair_once_a_segment(spark):
    assert simhash.segments_for(0) == simhash.segments_for(10**6) == simhash.SPLITS[0]
    assert simhash.segments_for(10**9) == simhash.SPLITS[1]
    rng = random.Random(9)
    fps = {0, 2**64 - 1, 2**63}
    for _ in range(60):
        a = rng.getrandbits(64)
        fps |= {a} | {a ^ sum(1 << b for b in rng.sample(range(64), k)) for k in (1, 2, 3, 4, 4, 4, 5)}
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    want = {(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 4}
    for split in simhash.SPLITS:
        assert sum(r for *_, r in split) + len(split) - 1 == simhash.MAX_BITS
        assert split[0][0] == 0 and sum(bits for _, bits, _ in split) == 64
        got = [tuple(sorted((u % 2**64, v % 2**64))) for u, v in simhash._links(df, 4, split).collect()]
        assert set(got) == want and max(got.count(x) for x in want) <= len(split)


@pytest.mark.parametrize("split", simhash.SPLITS)
def test_heavy_buckets_lose_no_link(spark, monkeypatch, split):
    monkeypatch.setattr(simhash, "HEAVY_BUCKET", 3)
    rng = random.Random(4)
    fps = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(25):
            f = centre
            for b in rng.sample(range(64), rng.randrange(5)):
                f ^= 1 << b
            fps.add(f)
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)),) for f in fps], "fp long")
    got = {}
    for node, root in components.components(simhash._links(df, 4, split)).collect():
        got.setdefault(root, set()).add(node % 2**64)
    group = {f: f for f in fps}
    changed = True
    while changed:
        changed = False
        for a in fps:
            low = min(group[b] for b in fps if (a ^ b).bit_count() <= 4)
            if low < group[a]:
                group[a], changed = low, True
    want = {}
    for f, g in group.items():
        want.setdefault(g, set()).add(f)
    assert sorted(map(sorted, got.values())) == sorted(sorted(s) for s in want.values() if len(s) > 1)


def test_packing(docs):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(BPE)
    rows = [r.asDict() for r in packing.pack(docs, BPE, window=64, open_windows=4).collect()]
    want = sorted((str(d), b"".join(struct.pack("<I", i) for i in [*tok.encode(t or "", add_special_tokens=False).ids, 1]))
                  for d, t in docs.select("doc_id", "text").collect())
    assert sum(r["length"] for r in rows) == sum(len(w) // 4 for _, w in want)
    seqs, parts = {}, {}
    for r in rows:
        assert r["length"] > 0 and zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        parts.setdefault((str(r["doc_id"]), r["doc_tokens"]), []).append((r["start"], r["ids"]))
    for s in seqs.values():
        s.sort()
        assert all(o == sum(n for _, n in s[:i]) for i, (o, _) in enumerate(s)) and sum(n for _, n in s) <= 64
    once = [p for k, p in parts.items() if sum(str(d) == k[0] for d, _ in want) == 1]
    texts = {w for _, w in want}
    assert once and all(b"".join(i for _, i in sorted(p)) in texts for p in once)
    fill = [sum(n for _, n in s) for s in seqs.values()]
    padded = sum(64 - n for n in fill if n & (n - 1))
    assert padded <= 0.3 * sum(fill)


def test_packing_never_exceeds_gap_when_full():
    sink = packing._Sink(0, 0, True)
    windows = packing.OpenWindows(sink, 32, 2, 3)
    rng = random.Random(6)
    total = 0
    for d in range(500):
        n = rng.randrange(1, 90)
        total += n
        windows.add((d, 0, bytes(4 * n), n))
        assert len(windows.rooms) <= 2
    left = windows.close()
    packing._powers_of_two(left, sink)
    sizes = {}
    for r in sink.rows:
        sizes[r[5]] = sizes.get(r[5], 0) + r[2]
    assert sum(sizes.values()) == total
    assert all(n >= 29 or n & (n - 1) == 0 for n in sizes.values())


def test_chunks_encode_as_whole_texts():
    from tokenizers import Tokenizer
    tok, enc = Tokenizer.from_file(BPE), packing.ChunkEncoder(BPE)
    rng = random.Random(1)
    parts = [" ", "  ", "\n", "\t", "\xa0", "a", "Bé", "1", "'s", "!?", "<|endoftext|>", "\x1c", "中", "²", "\0", "​", "word,"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(12))) for _ in range(4000)]
    want = [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in tok.encode_batch(texts, add_special_tokens=False)]
    assert enc.encode(texts) == want


def test_embedding_links(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 16))
    near = [b + rng.normal(size=16) * s for b in base[:20] for s in (0.05, 0.1, 0.2) for _ in range(4)]
    x = [*base, *near, base[0], base[0], base[0] * 3, np.zeros(16)]
    rows = [(i, [float(v) for v in r], 1, "x") for i, r in enumerate(x)]
    rows += [(900, None, 1, "x"), (901, [float("nan")] * 16, 1, "x"), (902, [None] * 16, 1, "x"), (903, [], 1, "x"),
             (904, [float("inf")] * 16, 1, "x"), (905, [1.0, 2.0], 1, "x"), (906, [1.0, 2.0], 1, "x"), (905, [1.0, 2.0], 1, "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, node int, raw string")
    got = sphere.embedding_components(df, cells=6).collect()
    u = np.array(x[:-1]) / np.linalg.norm(x[:-1], axis=1, keepdims=True)
    links = (u @ u.T >= 0.9).sum(1) - 1
    mine = {r["vec_id"]: r for r in got}
    assert [mine[i]["n_links"] for i in range(len(u))] == links.tolist()
    for i in [len(x) - 1, *range(900, 905)]:
        assert mine[i]["n_links"] == 0 and mine[i]["component_id"] == i and mine[i]["kept"]
    assert [r["n_links"] for r in got if r["vec_id"] in (905, 906)] == [2, 2, 2] and mine[906]["component_id"] == 905


def test_no_embedding_link_is_lost(spark):
    rng = np.random.default_rng(4)
    centre = rng.normal(size=64)
    centre /= np.linalg.norm(centre)
    hot = centre + rng.normal(size=(1200, 64)) * 0.33 / 8  # mean cosine about 0.9
    x = np.concatenate([hot, rng.normal(size=(600, 64)), rng.normal(size=(300, 64)) + 12 * centre])
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    group, low = np.arange(len(u)), None
    while low is None or (low != group).any():
        low, group = group, np.where(near, group, len(u)).min(1)
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    for cells in (None, 400):
        got = {r["vec_id"]: r for r in sphere.embedding_components(df, cells=cells).collect()}
        assert [got[i]["n_links"] for i in range(len(u))] == (near.sum(1) - 1).tolist()
        assert [got[i]["component_id"] for i in range(len(u))] == group.tolist()


def test_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = bytelang.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got.held_out]
    assert (held.held_out == (held.doc_id.map(lambda d: zlib.crc32(str(d).encode())) % 5 == 0)).all()
    assert (held.lang == held.lang_pred).mean() >= 0.95 and got.score.between(0, 1).all()


def test_language_edges(docs):
    rows = bytelang.identify(docs).collect()
    assert len(rows) == docs.count()
    und = docs.filter("text is null or not text rlike '\\\\p{L}'").count()
    assert sum(r["lang_pred"] == "und" for r in rows) == und
    windows, sizes = bytelang.windows_of(b"x" * 1000)
    assert sizes.sum() == 1000 and windows.shape[1] == bytelang.WINDOW
    none = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in bytelang.identify(none).collect()} == {"und"}


def test_pieces(docs):
    import sentencepiece
    model = pieces.PieceModel(PIECES)
    plain, sp = pieces.TextEncoder(model, 0, 0), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rng = random.Random(2)
    parts = [" ", "  ", "\n", "\t", "\xa0", "the", "é", "中", "😀", "hello world", "end.", "x"]
    for _ in range(2000):
        t = "".join(rng.choices(parts, k=rng.randrange(12)))
        assert list(struct.unpack(f"<{len(plain.encode(t)) // 4}I", plain.encode(t))) == sp.encode(t)
    some, other = pieces.TextEncoder(model, 0.3, 1), pieces.TextEncoder(model, 0.3, 2)
    text = "Several segmentations of one sentence, all decoding to the same text ▁ .\n" * 4
    assert some.encode(text) == some.encode(text) != other.encode(text) != plain.encode(text)
    assert model.decode(some.encode(text)) == model.decode(other.encode(text)) == text
    long = "ab" * 400
    assert pieces.merge_short(long, model.order, 5, 1 << 29) == pieces.merge_long(long, model.order, 5, 1 << 29)
    letters = ["a", "b", "th", "ing", "é", "中", "😀", "▁", "\0", "\udfff", "er", "st", "\n"]
    words = list({"".join(rng.choices(letters, k=rng.randrange(30))) for _ in range(2000)} | {"", long})
    for dropout in (0, 0.1, 0.5, 1):
        keys, merges = pieces.occurrence_keys(5, 0, len(words)), []
        got = model.segment_many(words, dropout, keys, merges)
        assert got == [model.segment(w, dropout, int(k)) for w, k in zip(words, keys)]
    # The skips of every occurrence are those of an agenda of its own.
    for text in ("the end of the end. The end.\nthe  end the " * 30, " ".join(rng.choices(words, k=300))):
        cut = some._words(text.replace(pieces.SPACE, pieces.SPACE_IN_TEXT))
        keys = pieces.occurrence_keys(pieces.xxh64_intdigest(text.encode("utf-8", "surrogatepass"), 1), 0, len(cut))
        want = b"".join(model.segment(w, 0.3, int(k)) for w, k in zip(some._spelt(cut), keys))
        assert some.encode(text) == some.encode(text) == want
    # A cache that turns over and a text longer than a group change nothing.
    texts = [" ".join(rng.choices(words, k=40)) for _ in range(60)] + ["the end. " * (pieces.GROUP_CHARS // 8), ""]
    want = [some.encode(t) for t in texts]
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(pieces, "CACHE_WORDS", 50)
        patch.setattr(pieces, "GROUP_CHARS", 900)
        assert list(pieces.TextEncoder(model, 0.3, 1).encode_many(texts)) == want
    # A frequent word is cut anew wherever it stands.
    one = pieces.TextEncoder(model, 0.1, 42)
    tail = struct.pack("<I", 0)
    in_texts = {one.encode(f"{i} internationalization").removesuffix(tail)[len(one.encode(f"{i}")):] for i in range(1000)}
    in_one = one._encoded(["internationalization"] * 1000, pieces.occurrence_keys(7, 0, 1000))
    assert len(in_texts) > 50 and len(set(in_one)) > 50
    rows = pieces.encode_texts(docs, PIECES).collect()
    assert all(r["lossless"] is (None if r["ids"] is None else True) for r in rows) and len(rows) == docs.count()


def test_ring(docs, spark):
    rows = ring.shard(docs, 7, vnodes=16).collect()
    assert len(rows) == docs.count()
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    sizes = [len(slots.get(s, [])) for s in range(7)]
    assert max(sizes) - min(sizes) <= 1 and all(sorted(v) == list(range(len(v))) for v in slots.values())
    want = sorted((str(d), len((t or "").encode()) + 16, zlib.crc32((t or "").encode()))
                  for d, t in docs.select("doc_id", "text").collect())
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in rows) == want


def test_walk_matches_one_by_one():
    rng = random.Random(8)
    for _ in range(50):
        shards = rng.randrange(1, 8)
        points = ring.ring(shards, 5)
        owners = [s for _, s in points]
        counts = [rng.choice([0, 1, 2, 30]) for _ in points]
        flows = ring.walk(owners, counts, shards)
        got = [0] * shards
        for arc, s, n in flows:
            got[s] += n
        assert sum(got) == sum(counts) and max(got) - min(got) <= 1
        assert all(sum(n for a, _, n in flows if a == arc) == c for arc, c in enumerate(counts))
        # Only the overflow leaves home.
        wanted = [sum(c for o, c in zip(owners, counts) if o == s) for s in range(shards)]
        home = sum(n for arc, s, n in flows if owners[arc] == s)
        assert home >= sum(min(w, g) for w, g in zip(wanted, got))


def test_pipeline_stages(spark):
    import corpus_pipeline as cp
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    kept = docs
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, kept, "/root/testdata/sf0.001")
        assert out.columns == docs.columns
        before, after = {r[0] for r in kept.select("doc_id").collect()}, {r[0] for r in out.select("doc_id").collect()}
        assert after <= before and len(after) >= 0.7 * len(before)
        if name == "simhash":
            reps = {r["component_id"] for r in simhash.simhash_components(kept).collect()}
            assert after == reps
        kept = out
    packed = cp.run(spark, "/root/testdata/sf0.001")
    assert {r[0] for r in packed.select("doc_id").distinct().collect()} == {r[0] for r in kept.select("doc_id").collect()}


def test_sql_matches(spark):
    import duckdb
    from dimforge.llm.queries import QUERIES
    from tools.oracle_check import norm
    con, sf = duckdb.connect(), "/root/testdata/sf0.001"
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    for name, (fn, sql) in QUERIES.items():
        if sql:
            df = fn(spark, sf)
            cols = sorted(df.columns)
            want = con.execute(f"SELECT {', '.join(cols)} FROM ({sql})").fetchall()
            assert sorted(map(str, map(norm, df.select(*cols).collect()))) == sorted(map(str, map(norm, want))), name


def test_decoding_of_packed_ids_in_parts(monkeypatch):
    import public_tokenizers
    from dimforge.llm import pieces
    model = pieces.piece_model(public_tokenizers.path("piece_bpe_32k.model"))
    encoder = pieces.TextEncoder(model, 0.1, 1)
    texts = ["", " ", "a", "two words\n\n and \u2581 more \U0001f600 \x00 \u0627", "\ud800 alone", "long " * 500]
    ids = list(encoder.encode_many(texts))
    assert [model.decode(p) for p in ids] == texts
    monkeypatch.setattr(pieces, "DECODE_IDS", 3)
    assert [model.decode(p) for p in ids] == texts


def test_pieces_encode_each_text_once(spark):
    """A plan in which decoding takes its own copy of the encoding does the work twice."""
    import re

    from dimforge.llm.queries import op9_pieces
    texts = [(1, "one text, one encoding"), (None, "an id that is null"), (2, None), (3, ""), (3, ""), (4, " \n▁ 😀\0  end ")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = pieces.encode_texts(docs, PIECES)
    for df in (found, found.select("doc_id", F.crc32("ids"), "n_ids", "lossless"), op9_pieces(spark, "/root/testdata/sf0.001")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        given = re.findall(r"ArrowEvalPython \[(.*)\], \[pythonUDF", plan)
        assert len(given) == 1 and len(re.findall(r"\btext#\d+", given[0])) == 1, plan
    # The values are those of the two steps taken one after the other.
    encoder = pieces.TextEncoder(pieces.PieceModel(PIECES), pieces.DROPOUT, pieces.SEED)
    want = [(i, None if t is None else encoder.encode(t), None if t is None else True) for i, t in texts]
    got = found.collect()
    assert sorted(map(str, ((r.doc_id, r.ids and bytes(r.ids), r.lossless) for r in got))) == \
        sorted(map(str, ((i, ids, lossless) for i, ids, lossless in want)))
    assert all(r.n_ids == len(r.ids or b"") // 4 for r in got)
    back = docs.select("text", pieces.decode_column(pieces.encode_column(F.col("text"), PIECES), PIECES).alias("back"))
    assert all(r.text == r.back for r in back.collect())


def test_remembered_symbols_hold_every_order():
    """The integers that remember words are wide enough for any model."""
    letters = [chr(0x4E00 + i) for i in range(260)]
    for n in (5, 32_767, 32_768, 66_000):
        pieces_of = letters[:3] if n == 5 else letters
        many = [*pieces_of, *(a + b for a in pieces_of for b in pieces_of)][:n]
        table = pieces.PairTable({p: i for i, p in enumerate(many)})
        known, last = pieces.Known(table), many[-1]
        words = [last, last + last, letters[-1] + "a"]
        known.add(words, words, [b""] * 3, [])
        symbols = pieces.spelt_symbols(words, pieces.SHORT, table)
        assert (known.symbols == symbols).all() and known.symbols.max() == table.other
        assert known.pairs[0, 0] == len(many) - 1 and known.pairs[2, 0] == known.pairs.min() == -1
