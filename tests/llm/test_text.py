"""op2, op8, op9 and op10."""

import re
import time

import numpy as np
import public_tokenizers
import pytest
import regex
from samples import SCHEMA, prose, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logloom.llm import bpe, chat_preference, pii, pretokenize, quality_lm

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def base_spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 14 <= len(digits(m)) <= 19 and pii.luhn(digits(m))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(digits(m)) <= 15]
    return sorted(out)


PARTS = ["a", "b.", "@", "x@y.z", ".", "1", "22", "255", "256", "1.2.3.4", " ", "-", "+", "+4", "(", ")", "é", "İ", "٣", "4785380592391139", "4111 1111 1111 1111", "+49 170 1234567"]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=25).map("".join))
def test_base_spans_equal_the_patterns(text):
    assert [s for s in pii.find_spans(text) if s[1] < 4] == base_spans(text)


def test_added_kinds_and_redaction():
    text = 'see https://a.example/x?y. IBAN: DE89370400440532013000; token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff", account no: 12345678. A token of love.'
    spans = pii.find_spans(text)
    assert [(pii.KINDS[k], text[s:e]) for s, k, e in spans] == [
        ("url", "https://a.example/x?y"), ("iban", "DE89370400440532013000"), ("secret", "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"), ("account", "12345678"),
    ]
    assert pii.redact(text, spans) == 'see [URL]. IBAN: [IBAN]; token = "[SECRET]", account no: [ACCOUNT]. A token of love.'
    assert pii.find_spans("1" * 50000 + "." * 50000 + "@" * 50000) == []


@pytest.mark.parametrize("unit", [*pii.SCHEMES, *pii.ACCOUNT_CUES, *(f"{c}=" for c in pii.SECRET_CUES), *pii.SECRET_CUES, "@", "a@", "+", "+1 ", "1", "1.", "1-", "a@b.", "http://x ", "1.1.1.1"])
def test_pii_takes_linear_time(unit):
    start = time.perf_counter()
    pii.find_spans(unit * (200_000 // len(unit)))
    assert time.perf_counter() - start < 2.5


def test_a_run_without_digits_hides_no_later_secret():
    text = "token=" * 50 + 'abcdefgh; secret: "abcdefghijklmnop1"'
    assert [text[s:e] for s, k, e in pii.find_spans(text) if pii.KINDS[k] == "secret"] == ["abcdefghijklmnop1"]


def test_pii_frame(docs, no_docs):
    out = pii.pii(docs.withColumns({"spans": F.lit(1), "_text": F.lit(2)}), redacted=True)
    row = out.filter("doc_id = 13").first()
    assert (row["n_email"], row["n_ip"], row["n_card"], row["n_phone"]) == (1, 1, 1, 1)
    assert row["redacted"] == "mail [EMAIL] or [PHONE], ip [IP], card [CARD]."
    assert out.count() == len(rows()) and out.filter("text IS NULL AND redacted = ''").count() == 1
    assert pii.pii(no_docs).count() == 0


PATH = public_tokenizers.path(bpe.DEFAULT_FILE)


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=40), st.lists(st.sampled_from(["a", "th", " ", "\n", "é", "日本", "ß", "🙂", "1", "²", "'s", "_", "!!", "==", "\xa0", "ا", "aaaa", "the ", "ing"]), max_size=40).map("".join)))
def test_bpe_equals_the_library(text):
    coder = bpe.byte_pairs(PATH)
    ids = np.frombuffer(coder.encode(text), np.uint32).tolist()
    assert ids == pretokenize.encoder(PATH).encode_ordinary(text)
    assert coder.decode(ids).decode() == text


@pytest.mark.parametrize("text", ["a" * 40000, " " * 20000, "ab" * 15000, "éß" * 9999])
def test_bpe_of_long_pieces(text):
    assert np.frombuffer(bpe.byte_pairs(PATH).encode(text), np.uint32).tolist() == pretokenize.encoder(PATH).encode_ordinary(text)


def test_plain_pattern_classes_agree():
    plain = [c for c in map(chr, range(0x110000)) if not "\ud800" <= c <= "\udfff" and not pretokenize._OTHER.match(c)]
    assert len(plain) > 1000
    for c in plain:
        for std, full in ((r"[^\W\d_]", r"\p{L}"), (r"\d", r"\p{N}"), (r"\s", r"\s")):
            assert bool(re.match(std, c)) == bool(regex.match(full, c)), hex(ord(c))


def test_bpe_frame(docs, no_docs):
    out = bpe.encode(docs.withColumns({"ids": F.lit("mine"), "_text": F.lit(2)}), decoded=True)
    got = out.select("text", "ids", "decoded").collect()
    assert len(got) == len(rows())
    for r in got:
        assert bytes(r["decoded"]).decode() == (r["text"] or "")
        assert r["ids"] == pretokenize.encoder(PATH).encode_ordinary(r["text"] or "")
    assert [bytes(r["decoded"]).decode() for r in bpe.decode(out.filter("doc_id = 14").drop("decoded")).collect()] == ["🙂 ünïcödé 日本語 " * 5]
    assert bpe.encode(no_docs).count() == 0


def kneser_ney(texts, order=quality_lm.ORDER):
    """Brute-force interpolated modified Kneser-Ney over byte n-grams."""
    from collections import Counter, defaultdict

    counts = {order: Counter()}
    for t in texts:
        d = b"\n" * (order - 1) + t.encode()
        counts[order].update(d[i : i + order] for i in range(len(d) - order + 1))
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])

    def discounts(c):
        n = [0] + [sum(v == k for v in c.values()) for k in range(1, 5)]
        out = {}
        for k in (1, 2, 3):
            if n[k] and n[k + 1]:
                y = n[1] / (n[1] + 2 * n[2]) if n[1] + 2 * n[2] else 0
                out[k] = max(0.0, min(k, k - (k + 1) * y * n[k + 1] / n[k]))
            else:
                out[k] = k - 0.25
        return out

    tables = []
    for c in (counts[k] for k in range(1, order + 1)):
        d, total, left = discounts(c), Counter(), defaultdict(float)
        for g, n in c.items():
            total[g[:-1]] += n
        for g, n in c.items():
            left[g[:-1]] += d[min(n, 3)]
        tables.append((c, d, total, left))

    def p(gram):
        if not gram:
            return 1 / 256
        c, d, total, left = tables[len(gram) - 1]
        h = gram[:-1]
        if not total[h]:
            return p(gram[1:])
        return max(c[gram] - d[min(c[gram], 3)] if c[gram] else 0, 0) / total[h] + left[h] / total[h] * p(gram[1:])

    return p


def perplexity(p, text, order=quality_lm.ORDER):
    d = b"\n" * (order - 1) + text.encode()
    return 2 ** (-sum(np.log2(p(d[i : i + order])) for i in range(len(d) - order + 1)) / (len(d) - order + 1))


@pytest.mark.parametrize("head", [1 << 19, 300, 0])
def test_quality_model(spark, monkeypatch, head):
    """However much of the model is sent to the tasks and however much is joined."""
    monkeypatch.setattr(quality_lm, "HEAD_ENTRIES", head)
    monkeypatch.setattr(quality_lm, "STEP", 700)
    clean = [(i, prose(i, 30), "en" if i % 2 else "de", "s", 0) for i in range(60)]
    odd = [(100, "###$$$%%% ZZZ!! QQQ" * 5, "en", "s", 0), (101, None, "en", "s", 0), (102, "", None, "s", 0), (103, prose(3, 20), "fr", "s", 0), (None, prose(4, 20) + " ünï 日本", "en", "s", 0), (3, prose(3, 30), "en", "s", 0)]
    docs = spark.createDataFrame(clean + odd, SCHEMA)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)] + [(100, 0, 0), (100, 1, 0), (None, 1, 0), (5, None, None)], "doc_id bigint, quality int, toxic int")
    named = {c: F.lit(7) for c in ("kept", "bits", "model", "own", "row", "fold", "good", "sum", "_lang", "_text", "_limit")}
    rows = quality_lm.quality(docs.withColumns(named), labels).collect()
    assert len(rows) == len(clean) + len(odd) and {r["bits"] for r in rows} == {7}
    fold = {r["text"]: r["f"] for r in docs.select("text", quality_lm._fold(F.coalesce("text", F.lit(""))).alias("f")).collect()}
    trusted = [(t, lang) for _, t, lang, *_ in [*clean, odd[-1]]]  # a null label says nothing
    models = {(f, x): kneser_ney([t for t, lang in trusted if fold[t] == f and x in (lang, None)]) for f in (0, 1) for x in ("en", "de", None)}
    for r in rows:
        if r["text"]:
            model = models[1 - fold[r["text"]], r["lang"] if r["lang"] != "fr" else None]
            assert r["perplexity"] == pytest.approx(perplexity(model, r["text"]), rel=1e-6)
    kept = {r["doc_id"]: r["kept"] for r in rows}
    assert not kept[100] and all(kept[i] for i in (101, 102, 103)) and sum(kept[i] for i in range(60)) >= 54
    assert all(r["perplexity"] is None for r in rows if not r["text"])


def test_quality_without_trust_or_rows(docs, no_docs, spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert {r["kept"] for r in quality_lm.quality(docs, none).collect()} == {True}
    assert quality_lm.quality(no_docs, none).count() == 0


@pytest.mark.parametrize("trusted", [0, 3])
def test_quality_keeps_a_language_with_few_labels(spark, trusted):
    other = "".join(chr(c) for c in range(0x3B1, 0x3C9))
    texts = [" ".join(other[(i * 5 + k * k) % 20 :][: 3 + k % 4] for k in range(40)) for i in range(12)]
    rows = [(i, prose(i, 30), "en", "s", 0) for i in range(30)] + [(100 + i, t, "el", "s", 0) for i, t in enumerate(texts)]
    labels = spark.createDataFrame([(i, 1, 0) for i in (*range(30), *range(100, 100 + trusted))], "doc_id bigint, quality int, toxic int")
    out = quality_lm.quality(spark.createDataFrame(rows, SCHEMA), labels).filter("lang = 'el'").collect()
    assert len(out) == 12 and all(r["kept"] and r["threshold"] is None and r["perplexity"] > 1 for r in out)


def test_quality_limit_is_held_out(spark):
    """Unseen texts of a language stay as often as the quantile says, not only those that were trained on."""
    rows = [(i, prose(i, 30), "en", "s", 0) for i in range(200)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id bigint, quality int, toxic int")
    out = quality_lm.quality(spark.createDataFrame(rows, SCHEMA), labels).collect()
    assert sum(r["kept"] for r in out if r["doc_id"] >= 40) >= 0.85 * 160


def test_quality_limit_follows_the_bad_documents(spark):
    good = [("a", v / 1000, True) for v in range(1000, 2000)] + [("b", v / 1000, True) for v in range(1000, 2000)]
    bad = [("a", 1.96, False)] * 5 + [("b", 5.0, False)] * 5
    odd = [("c", 1.0, True)] * 29 + [("c", 30.0, True)] + [("d", 1.0, True)] * 19
    rows = quality_lm.limits(spark.createDataFrame(good + bad + odd, "lang string, bits double, good boolean")).collect()
    assert {r["lang"]: r["threshold"] for r in rows} == pytest.approx({"a": 1.949, "b": 1.998, "c": 1.0}, abs=2e-3)


def test_quality_quantile_is_the_rank(spark):
    values = [(("a", v / 1000)) for v in range(1, 1001)]
    row = quality_lm.quantiles(spark.createDataFrame(values, "lang string, bits double"), 0.9).first()
    assert row["threshold"] == 0.9


def turns(spark, *rows):
    return spark.createDataFrame(list(rows), "conv_id bigint, turn bigint, role string, text string")


def test_preference_pairs(spark):
    df = turns(
        spark,
        (0, 0, "user", "hi"), (0, 1, "assistant", "yes"), (0, 2, "user", "more?"), (1, 0, "user", "ho"), (1, 1, "assistant", "no"),
        (4, 0, "system", "s"), (4, 1, "user", "alone"), (6, 0, "user", "q"), (6, 1, "assistant", None), (6, 1, "assistant", None), (None, 0, "user", "lost"),
    )
    out = {r["conv_id"]: r for r in chat_preference.preference_format(chat_preference.reply_pairs(df.withColumn("extra", F.lit(1)))).collect()}
    assert set(out) == {0, 1, 4, 6}
    row = out[0]
    assert (row["n_prompt_turns"], row["prompt"], row["chosen"], row["rejected"]) == (1, "<|user|>\nhi<|end|>\n", "<|assistant|>\nyes<|end|>\n<|user|>\nmore?<|end|>\n", "<|assistant|>\nno<|end|>\n<|user|>\nmore?<|end|>\n")
    assert (row["chosen_mask"], row["rejected_mask"], row["trainable"]) == ("14:0,11:1,9:0,13:0", "14:0,10:1,9:0,13:0", True)
    assert (out[4]["trainable"], out[4]["chosen"], out[4]["n_prompt_turns"]) == (False, "", 2)
    assert (out[6]["trainable"], out[6]["n_prompt_turns"]) == (False, 2)


def test_longest_common_prefix_of_given_pairs(spark):
    t = "array<struct<role:string,text:string>>"
    df = spark.createDataFrame(
        [(1, [("user", "a"), ("assistant", "b")], [("user", "a"), ("assistant", "b"), ("user", "c")]), (2, [("user", "a"), ("assistant", "b")], [("user", "z")]), (3, None, [("user", "z")]), (4, [], [])],
        f"conv_id bigint, chosen {t}, rejected {t}",
    )
    got = {r["conv_id"]: (r["n_prompt_turns"], r["chosen_mask"], r["rejected_mask"], r["trainable"]) for r in chat_preference.preference_format(df).collect()}
    assert got == {1: (2, "", "9:0,9:0", False), 2: (0, "9:0,9:0,14:0,9:1", "9:0,9:0", True), 3: (0, "", "9:0,9:0", False), 4: (0, "", "", False)}
    assert chat_preference.preference_format(chat_preference.reply_pairs(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string"))).count() == 0
