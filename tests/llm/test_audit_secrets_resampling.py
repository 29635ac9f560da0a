"""op11 to op13 against brute force, and their odd cases."""

import math
import random
import re
import zlib
from hashlib import sha256
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from logloom.llm import char_cnn, filter_audit, importance, secret_scan

# op11


def brute_base(text):
    out = []
    patterns = (("assign", r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""", 8), ("access", "(AKIA[A-Z0-9]+)", 16), ("hex", "([0-9a-f]+)", 32))
    for kind, pattern, least in patterns:
        out += [(m.start(), secret_scan.KINDS.index(kind), m.end()) for m in re.finditer(pattern, text) if len(m[1]) >= least]
    return sorted(out)


PARTS = ["token", "TOKEN", "api_key", "ApiKey", "passwd", "password", "secret", "=", ":", " ", '"', "'", "\n", "AKIA", "AKIAABCDEFGHIJKL23", "0123456789abcdef" * 2, "0123456789abcdef0", "f", "A", "hunter22", ".", "-", "ſecret", "toKen", "é", "🙂", "word", "x@y", "://", "x" * 13]


def test_base_spans_equal_the_patterns():
    rng = random.Random(5)
    for _ in range(3000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randrange(12)))
        spans, found = secret_scan.candidates(text)
        assert spans == brute_base(text), text
        # Other candidates touch no base span.
        assert all(y == 1 or all(b <= s or e <= a for s, _, e in spans) for a, b, y in found)


@pytest.mark.parametrize("unit", ["token ", "token=", "AKIA", "0a", "a-", "x@", "password: '"])
def test_scan_is_linear(unit):
    import time

    text = unit * (400_000 // len(unit))
    start = time.perf_counter()
    secret_scan.candidates(text)
    assert time.perf_counter() - start < 5


def naive_logit(net, example):
    (codes, _) = char_cnn.laid_out([example])
    windows = [codes[i : i + char_cnn.WIDTH] for i in range(len(codes) - char_cnn.WIDTH + 1)]
    best = np.max([net.conv_bias + sum(net.conv[k][w[k]] for k in range(char_cnn.WIDTH)) for w in windows], axis=0)
    inner = np.maximum(np.maximum(best, 0) @ net.hidden + net.hidden_bias, 0)
    return inner @ net.out + net.out_bias


def test_network_equals_a_plain_one_for_any_length(monkeypatch):
    net = char_cnn.Network.new(filters=4, hidden=3, seed=1)
    examples = [("ab key=0aF9", 7, 11), ("", 0, 0), ("x" * 400 + "Zé🙂", 3, 402), ("q", 0, 1)]
    want = [naive_logit(net, e) for e in examples]
    for block in (7, 64, 1 << 15):
        monkeypatch.setattr(char_cnn, "_BLOCK", block)
        assert np.allclose(net.logits(examples), want)


def test_gradients_equal_differences():
    from dataclasses import replace

    net = char_cnn.Network.new(filters=3, hidden=4, seed=3)
    examples, y, w = [("id abc12", 3, 8), ("zz top", 0, 2), ("k=9f8e", 2, 6)], np.array([1.0, 0, 1]), np.array([1.0, 2, 1])

    def loss(n):
        p = 1 / (1 + np.exp(-n.logits(examples)))
        return -(w * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / w.sum()

    grads = dict(zip(net.__dataclass_fields__, net.gradients(examples, y, w), strict=True))
    code = int(char_cnn.laid_out(examples)[0][4])
    for name, at in (("conv", (2, code, 1)), ("conv_bias", (0,)), ("hidden", (1, 2)), ("hidden_bias", (3,)), ("out", (2,)), ("out_bias", ())):
        moved = []
        for d in (1e-6, -1e-6):
            value = getattr(net, name).copy()
            value[at] += d
            moved.append(loss(replace(net, **{name: value})))
        assert math.isclose((moved[0] - moved[1]) / 2e-6, grads[name][at], abs_tol=1e-5), name


def secret_rows(n=400):
    rng = random.Random(11)
    words = ["considerable", "understanding", "representative", "transportation", "international", "lamp", "tree", "green"]
    rows = []
    for i in range(n):
        text = " ".join(rng.choice(words) for _ in range(30))
        if i % 4 == 0:
            value = "".join(rng.choice("0123456789abcdef") for _ in range(40))
            text += f' token = "{value}" ' + " ".join(rng.choice(words) for _ in range(9))
        if i % 50 == 1:
            text += " use " + "".join(rng.choice("abcdefghijkmnpqrstuvwxyzABCDEFGH23456789") for _ in range(36)) + " here"
        rows.append((i, text))
    return rows


def test_network_adds_unlabelled_secrets_and_leaves_clean_text(spark):
    docs = spark.createDataFrame(secret_rows(), "doc_id bigint, text string")
    found = secret_scan.scanned(docs, ["doc_id"])
    model = secret_scan.fitted(found)
    assert model.recall >= 0.95 and model.precision >= 0.95
    out = {r["doc_id"]: r for r in secret_scan.secret_scan(docs, scanner=model).collect()}
    for i, text in secret_rows():
        base = [(s["start"], secret_scan.KINDS.index(s["kind"]), s["end"]) for s in out[i]["spans"] if s["kind"] != "net"]
        assert base == brute_base(text)
    planted = [i for i, _ in secret_rows() if i % 50 == 1]
    added = {i for i, r in out.items() if any(s["kind"] == "net" for s in r["spans"])}
    assert len(added & set(planted)) >= 0.8 * len(planted) and len(added - set(planted)) <= 2


def test_network_learns_from_all_findings_however_they_are_spread(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(14))
    rows = [(i, f'{word()} token = "{"".join(rng.choice("0123456789abcdef") for _ in range(40))}" {word()} and {word()}') for i in range(1_100)]
    rows.append((-1, "password = " + "".join(rng.choice("abcXYZ019") for _ in range(3_000))))
    found = secret_scan.scanned(spark.createDataFrame(rows, "doc_id bigint, text string"), ["doc_id"]).persist()
    labelled = {(c["label"], c["lead"], c["end"] - c["start"], c["around"]) for r in found.collect() for c in r["candidates"] if c["label"] is not None}
    assert sum(y for y, *_ in labelled) == 1_101 and len(labelled) > 4_000
    models = [secret_scan.fitted(f, shard=1_500) for f in (found, found.repartition(5))]
    assert [m.findings for m in models] == [len(labelled)] * 2 and models[0].recall >= 0.95
    assert models[0].thresholds == models[1].thresholds and np.array_equal(models[0].network.conv, models[1].network.conv)


def test_shards_share_few_findings_of_a_class(spark):
    rows = [(i, f"{w}{'x' * 8} token = {i:032x}") for i, w in enumerate("ab" * 6)] + [(99, " ".join("".join(p) for p in permutations("abcde")).replace(" ", "lmnopqrst "))]
    found = secret_scan.findings(secret_scan.scanned(spark.createDataFrame(rows, "doc_id bigint, text string"), ["doc_id"]), shard=20)
    held = found.rows.groupBy("shard").agg(F.count_if(F.col("label") == 1).alias("secrets")).collect()
    assert len(held) == found.shards > 5 and min(r["secrets"] for r in held) > 0
    assert found.rows.filter("copy = 0").count() == found.harmless + found.secrets


def test_secret_scan_odd_rows(spark, docs, no_docs):
    own = docs.withColumns({"spans": F.lit(1), "_text": F.lit("kept"), "a.b": F.lit(2), "_spans": F.lit(3), "_candidates": F.lit(4)})
    carry = ["doc_id", "_text", "a.b", "_spans", "_candidates", "spans"]
    rows = secret_scan.secret_scan(own, carry).collect()
    assert len(rows) == docs.count()  # null ids, repeated rows, null and empty texts
    assert {(r["_text"], r["a.b"], r["_spans"], r["_candidates"]) for r in rows} == {("kept", 2, 3, 4)}
    assert secret_scan.secret_scan(no_docs).collect() == []
    assert secret_scan.secret_scan(no_docs).columns == ["doc_id", "spans", "n_assign", "n_access", "n_hex"]


# op12


def brute_masks(rows):
    out = []
    for doc_id, text, _ in rows:
        text = text or ""
        words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
        fails = set()
        fails |= {"A"} if len(words) < 200 else set()
        fails |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        fails |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text) else set()
        fails |= {"D"} if re.search("[#$%&*|]", text) else set()
        fails |= {"E"} if doc_id is not None and any(o is not None and o < doc_id and (t or "") == text for o, t, _ in rows) else set()
        out.append(fails)
    return out


def test_audit_equals_walking_every_order(spark):
    rng = random.Random(3)
    base = ["w " * 250, " ".join(f"w{i}" for i in range(220)), "SHOUT " * 3, "a # b", "", None, " ".join(f"x{i}" for i in range(300)) + " |", "\x0bone\x1ctwo\x85 three"]
    rows = [(i if i != 7 else None, rng.choice(base), rng.choice(["s1", "s2", None, ""])) for i in range(60)]
    rows += [(3, rows[3][1], "s1"), (3, rows[3][1], "s1"), (None, rows[5][1], "s2")]
    said = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 60, 2)] + [(4, 1, None), (None, 1, 1)]
    good, toxic = {i for i, q, _ in said if q == 1 and i is not None}, {i for i, _, t in said if t == 1 and i is not None}
    fails = brute_masks(rows)
    want = {}
    for part in {s or "" for *_, s in rows}:
        own = [(i, f) for (i, _, s), f in zip(rows, fails, strict=True) if (s or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, name in enumerate(order, 1):
                gone = [(i, f) for i, f in left if name in f]
                left = [(i, f) for i, f in left if name not in f]
                shapley[name] += len(gone)
                want[part, "".join(order), step] = [len(left), len(gone), sum(name in f for _, f in own) - len(gone), sum(f == {name} for _, f in own), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)]
        for (p, order, step), row in want.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").withColumns({"mask": F.lit(1), "part": F.lit("x"), "a.b": F.lit(0)})
    labels = spark.createDataFrame(said, "doc_id bigint, quality int, toxic int").withColumn("good", F.lit(1))
    out = filter_audit.audit(filter_audit.masks(docs), labels)
    got = {(r["part"], r["filter_order"], r["step"]): [r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")] for r in out.collect()}
    assert got == want
    assert dict(out.dtypes) == {"part": "string", "filter_order": "string", "step": "int"} | dict.fromkeys(("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"), "bigint")


def test_audit_of_nothing(spark, no_docs):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert filter_audit.audit(filter_audit.masks(no_docs), labels).collect() == []


def test_audit_without_labels(spark, docs):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    out = filter_audit.audit(filter_audit.masks(docs), labels)
    assert out.count() == 600 * 2  # the parts "s" and ""
    assert out.agg(F.sum("good_lost"), F.sum("toxic_lost")).first() == (0, 0)


# op13


def brute_resample(docs, target):
    def words(text):
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        out, word = [], ""
        for c in text + " ":
            if c.isascii() and not (c.isdigit() or "a" <= c <= "z"):
                out += [word] if word else []
                word = ""
            else:
                word += c
        return out

    def buckets(text):
        w = words(text)
        return [zlib.crc32(f.encode()) % 10_000 for f in w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]]

    s, t = np.zeros(10_000, int), np.zeros(10_000, int)
    for counts, texts in ((s, [x for _, x in docs]), (t, target)):
        for text in texts:
            for b in buckets(text):
                counts[b] += 1
    big_s, big_t = int(s.sum()), int(t.sum())
    gain = [math.floor(1000 * math.log((int(t[b]) + 1) * (big_s + 10_000) / ((int(s[b]) + 1) * (big_t + 10_000)))) for b in range(10_000)]
    out = []
    for doc_id, text in docs:
        own = buckets(text)
        weight = sum(gain[b] for b in own) // len(own) if own else 0
        h = int(sha256(f"7:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words(text))])
    may = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1], r[2]))
    for rank, row in enumerate(may[: 25 * len(may) // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=repr)


def test_resampling_equals_brute_force(spark, docs):
    own = docs.withColumns({"score": F.lit("x"), "n_words": F.lit(0), "a.b": F.lit(0)})
    target = [("alpha12 beta3 Gamma, delta!",), (None,), ("a line that is shared by several documents",), ("日本語 ünïcödé",)]
    bench = spark.createDataFrame([(i, t) for i, (t,) in enumerate(target)], "item_id bigint, text string")
    got = sorted((tuple(r) for r in importance.resample(own, bench).collect()), key=repr)
    assert got == brute_resample([(r["doc_id"], r["text"]) for r in docs.collect()], [t for (t,) in target])


def test_resampling_of_many_ties(spark):
    rows = [(i % 40 if i % 7 else None, " ".join(f"w{(i % 3) * k}" for k in range(25))) for i in range(200)]
    docs, bench = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame([], "item_id bigint, text string")
    got = sorted((tuple(r) for r in importance.resample(docs, bench).collect()), key=repr)
    assert got == brute_resample(rows, [])
    assert sorted(r[4] for r in got if r[4]) == list(range(1, 51))


def test_resampling_of_nothing(spark, no_docs):
    bench = spark.createDataFrame([(1, "x y")], "item_id bigint, text string")
    assert importance.resample(no_docs, bench).collect() == []


def test_words_have_the_offsets_of_the_pattern():
    rng = random.Random(2)
    for _ in range(500):
        text = "".join(rng.choice(["a", "z9", " ", "\x00", "\n", "é", "🙂", "_", "\x7f", "\x80", "\x85", "-"]) for _ in range(30))
        assert importance.words_of(text) == [(m[0], m.span()) for m in re.finditer(importance.WORD, text)]
