"""op1, op6 and op7 against brute force."""

import hashlib
from collections import Counter, defaultdict

from samples import LINE, prose, rows
from pyspark.sql import functions as F

from logloom.llm import exact_dedup, line_dedup, near_dedup

UP = {ord(c): ord(c) + 32 for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def line_reference(data):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(UP)
    split = [(i, (t or "").split("\n")) for i, t, *_ in data]
    holders = defaultdict(set)
    for i, lines in split:
        for x in lines:
            holders[key(x)].add(i)
    out = []
    for i, lines in split:
        stay = []
        for x in lines:
            k, ids = key(x), holders[key(x)]
            if not (len(k) >= 20 and len(ids) >= 3 and i != max((h for h in ids if h is not None), default=None)):
                stay.append(x)
        out.append((i, len(lines), len(lines) - len(stay), sha("\n".join(stay))))
    return Counter(out)


def test_line_dedup(docs, no_docs):
    out = line_dedup.line_dedup(docs)
    got = Counter((r["doc_id"], r["n_lines"], r["n_dropped"], sha(r["kept_text"])) for r in out.collect())
    assert got == line_reference(rows())
    assert out.filter("doc_id = 9").first()["kept_text"] == "own line nine is here"
    assert line_dedup.line_dedup(no_docs).count() == 0


def test_line_dedup_all_lines_lost_and_clashing_columns(spark):
    df = spark.createDataFrame([(i, LINE, "mine") for i in (1, 2, 3)], "doc_id bigint, text string, kept_text string")
    df = df.withColumns({c: F.lit("mine") for c in ("_t", "_lines", "_lost", "_lost_id", "_lost_t", "_id", "_pos")})
    got = {r["doc_id"]: (r["kept_text"], r["n_dropped"]) for r in line_dedup.line_dedup(df).collect()}
    assert got == {1: ("", 1), 2: ("", 1), 3: (LINE, 0)}
    assert "_1" not in line_dedup.line_dedup(df).columns


def test_exact_dedup(docs, no_docs):
    groups = defaultdict(list)
    for i, t, *_ in rows():
        groups[(t or "").translate(UP)].append(i)
    want = Counter()
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        # One row of each group is kept, also where rows repeat its id.
        want.update((i, keep, len(ids), k == ids.index(keep), sha(t)) for k, i in enumerate(ids))
    odd = docs.withColumns({c: F.lit("mine") for c in ("row", "recipe", "kept", "keep_id", "last", "_row", "_text")})
    got = Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in exact_dedup.exact_dedup(odd).collect())
    assert got == want
    assert exact_dedup.exact_dedup(no_docs).count() == 0


def test_chunks_make_up_the_text(spark):
    texts = ["", "a", "x." * 3000, "y" * 9000, "🙂é" * 2000 + ".\n", prose(3, 900).replace("7", ".")]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", exact_dedup.chunks_of(F.col("t")).alias("c")).collect()
    assert all("".join(r["c"]) == r["t"] and max(map(len, r["c"])) <= 2048 for r in rows)


def test_chunks_meet_again_after_an_insertion(spark):
    base = ". ".join(prose(k, 12) for k in range(200))
    a, b = (set(r[0]) for r in spark.createDataFrame([(base,), ("new words. " + base,)], "t string").select(exact_dedup.chunks_of(F.col("t"))).collect())
    assert len(a & b) > 0.8 * len(a)


def test_colliding_hashes_are_told_apart(spark):
    df = spark.createDataFrame([(1, bytearray(b"a")), (1, bytearray(b"b")), (2, bytearray(b"c"))], "_h bigint, _sha binary")
    assert {(r["_h"], r["_rank"]) for r in exact_dedup.verified_ids(df.union(df)).collect()} == {(1, 0), (1, 1)}


def shingle_weights(text):
    words = (text or "").lower().split()
    return Counter(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else Counter()


def jp(x, y):
    both = x.keys() | y.keys()
    return sum(1 / sum(max(x[e] / x[d], y[e] / y[d]) for e in both) for d in x.keys() & y.keys())


def near_reference(data):
    """Index lists of the classes over all pairs."""
    weights = [shingle_weights(t) for _, t, *_ in data]
    parent = list(range(len(data)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(data)):
        for b in range(a):
            same = weights[a] == weights[b] and (data[a][1] or "").lower().split() == (data[b][1] or "").lower().split()
            if same or (weights[a] and weights[b] and jp(weights[a], weights[b]) >= 0.8):
                parent[find(a)] = find(b)
    return [find(k) for k in range(len(data))]


def near_wanted(data):
    of = near_reference(data)
    least, size = {}, Counter(of)
    for k, r in enumerate(data):
        if r[0] is not None:
            least[of[k]] = min(least.get(of[k], r[0]), r[0])
    return Counter((r[0], least.get(of[k]), size[of[k]]) for k, r in enumerate(data))


def test_near_classes(docs, no_docs):
    short = [r for r in rows() if len(r[1] or "") < 4000]
    spark = docs.sparkSession
    got = Counter(map(tuple, near_dedup.near_classes(spark.createDataFrame(short, docs.schema)).collect()))
    assert got == near_wanted(short)
    whole = {r["doc_id"]: r["class_id"] for r in near_dedup.near_classes(docs).collect()}
    assert whole[6] == whole[7] == whole[8] == 6 and whole[18] == 18
    assert near_dedup.near_classes(no_docs).count() == 0


def test_hot_group_of_edited_copies(spark, monkeypatch):
    """One base with more and more edits: the stars alone leave several components."""
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    base = prose(4, 120).split()
    data = []
    for k in range(70):
        words = list(base)
        for e in range(k % 9):
            words[(k * 37 + e * 13) % len(words)] = f"edit{k % 31}x{e}"
        data.append((k, " ".join(words)))
    got = Counter(map(tuple, near_dedup.near_classes(spark.createDataFrame(data, "doc_id bigint, text string")).collect()))
    assert got == near_wanted(data)


def test_hot_group_has_about_one_link_a_member(spark):
    """However many buckets the members share."""
    base = prose(8, 200).split()
    data = []
    for k in range(400):
        words = list(base)
        words[k % 200] = f"edit{k}"
        data.append((k, " ".join(words)))
    docs = spark.createDataFrame(data, "doc_id bigint, text string")
    signed = near_dedup.written(near_dedup.sign(docs))
    spread = signed.select(F.explode("bands").alias("key"), F.col("row").alias("node"))
    centres = spread.groupBy("key").agg(F.min_by("node", near_dedup._draw("node")).alias("centre"))
    links = near_dedup.star_links(spread.join(centres, "key"), signed)
    labels = near_dedup.components(links)
    assert links.count() <= 1.1 * len(data) and labels.select("label").distinct().count() == 1
    assert {(r["class_id"], r["class_size"]) for r in near_dedup.near_classes(docs).collect()} == {(0, 400)}


def test_blocks_of_long_documents_are_bounded_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_BYTES", 2000)
    base = prose(5, 120).split()
    data = []
    for k in range(40):
        words = list(base)
        for e in range(k % 9):
            words[(k * 37 + e * 13) % len(words)] = f"edit{k % 31}x{e}"
        data.append((k, " ".join(words)))
    got = Counter(map(tuple, near_dedup.near_classes(spark.createDataFrame(data, "doc_id bigint, text string")).collect()))
    assert got == near_wanted(data)


def test_near_classes_of_clashing_columns(docs):
    short = docs.filter("length(text) < 500")
    odd = short.withColumns({c: F.lit("mine") for c in ("row", "node", "label", "class_id", "words", "content", "bands", "key")})
    assert Counter(map(tuple, near_dedup.near_classes(odd).collect())) == Counter(map(tuple, near_dedup.near_classes(short).collect()))


def test_signatures_estimate_probability_jaccard():
    import numpy as np

    rng = np.random.default_rng(1)
    pairs = []
    for share in (0.2, 0.5, 0.8):
        n = 400
        a = {int(x): int(w) for x, w in zip(rng.integers(1, 1 << 40, n), rng.integers(1, 5, n))}
        b = {x if rng.random() < share else int(rng.integers(1, 1 << 40)): w for x, w in a.items()}
        got = []
        for x in (a, b):
            e = np.array(sorted(x), np.uint64)
            got.append((e, np.array([x[int(k)] for k in e], float)))
        exact = near_dedup.probability_jaccard(*got)
        assert abs(exact - jp(Counter(a), Counter(b))) < 1e-9
        doc = np.concatenate([np.zeros(len(got[0][0]), int), np.ones(len(got[1][0]), int)])
        sig = near_dedup.prob_minhash(doc, np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got]), 2, 4096)
        pairs.append((exact, (sig[0] == sig[1]).mean()))
    assert all(abs(a - b) < 0.04 for a, b in pairs), pairs
