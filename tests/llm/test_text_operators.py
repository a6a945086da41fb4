"""The text operators against brute force, and their odd cases: nulls, empty and long texts, repeats, clashing columns."""

from __future__ import annotations

import re

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerwatch.llm import leaks, packing, simhash
from ledgerwatch.llm.components import connected_components
from ledgerwatch.llm.language_model import score_texts
from ledgerwatch.llm.leaks import alignment, find_leaks
from ledgerwatch.llm.packing import nnls, packed_documents, sequences, token_pieces, word_ids
from ledgerwatch.llm.quality import ablation, keep_good, ledger
from ledgerwatch.llm.secrets import redact, scan_secrets
from ledgerwatch.llm.tokens import count_tokens, encoder, spliced_count
from ledgerwatch.llm.toxicity import score_toxicity
from ledgerwatch.llm.urls import judge_urls
from ledgerwatch.llm.weak_labels import score_quality

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, d string, w string, row long"
PIECES, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")


def table(spark, texts, ids=None):
    ids = ids or range(len(texts))
    return spark.createDataFrame([(i, t, "en", f"s{i}", len(t or ""), "x", "y", 7) for i, t in zip(ids, texts)], SCHEMA)


def prose(seed: int, n: int) -> str:
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("abcdefghij"), rng.integers(2, 9))) for _ in range(n)) + "."


ODD = [None, "", " \n\t", "one", "one", "Long " + prose(1, 30_000), prose(2, 80), prose(2, 80)]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def brute_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    s = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints_and_components(spark):
    texts = ODD + [prose(3, 200), prose(3, 200) + " more"]
    got = {r.doc_id: r for r in simhash.near_duplicates(table(spark, texts)).collect()}
    assert {i: int(r.fingerprint, 16) for i, r in got.items()} == {i: brute_fingerprint(t) for i, t in enumerate(texts)}
    assert got[1].component_id == got[2].component_id == 0 and got[4].component_id == 3 and got[7].component_id == 6
    assert simhash.near_duplicates(table(spark, [])).count() == 0


@pytest.mark.parametrize("crowd", [2, 8, 1000])
def test_links_join_what_all_pairs_join(spark, crowd):
    rng = np.random.default_rng(5)
    centres = rng.integers(-(2**62), 2**62, 6)
    fps = {int(c) for c in centres}
    for c in centres[:3]:
        fps |= {int(c ^ (1 << int(a)) ^ (1 << int(b))) for a, b in rng.integers(0, 60, (25, 2))}
    fps = sorted(fps)
    parent = {f: f for f in fps}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= 2 or ((a ^ b) & (2**64 - 1)).bit_count() <= 2:
                x, y = top(a), top(b)
                parent[max(x, y)] = min(x, y)
    links = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"), crowd)
    got = {r.node: r.label for r in connected_components(links).collect()}
    assert {f: got.get(f, f) for f in fps} == {f: top(f) for f in fps}


def test_chain_is_one_component(spark):
    got = connected_components(spark.createDataFrame([(i, i + 1) for i in range(60)] + [(5, 5), (None, 3)], "a long, b long")).collect()
    assert {r.label for r in got} == {0} and len(got) == 61


def test_one_of_each_group_stays(spark):
    kept = simhash.keep_one_of_each(table(spark, [prose(1, 50), prose(1, 50), prose(2, 50), prose(3, 9), prose(3, 9)], [4, 3, 9, 1, 1]))
    assert [r[0] for r in rows(kept)] == [1, 3, 9] and kept.columns == [c.split()[0] for c in SCHEMA.split(", ")]


def test_rows_are_told_apart_by_id_and_text(spark):
    a, b, c = prose(1, 60), prose(2, 60), prose(3, 60)
    docs = table(spark, [a, b, a, c, c, None, "", b], [None, 7, None, None, None, 5, None, 7])
    assert sorted((r.doc_id, r.text) for r in simhash.keep_one_of_each(docs).where("doc_id IS NOT NULL").collect()) == [(5, None), (7, b)]
    assert sorted(r.text for r in simhash.keep_one_of_each(docs).where("doc_id IS NULL").collect()) == sorted([a, c])
    shared = table(spark, [a, b, a], [3, 3, 3])  # unrelated texts under one id both stay
    assert sorted(r.text for r in simhash.keep_one_of_each(shared).collect()) == sorted([a, b])
    assert simhash.keep_one_of_each(table(spark, [])).count() == 0


def test_copies_within_two_bits_go_as_by_brute_force(spark):
    texts = ODD[:5] + [prose(k, 600) + f" tail{j}" for k in range(12) for j in range(4)] + ["a b", "A  b", "b a", "a b c d"]
    prints = [brute_fingerprint(t) for t in texts]
    top = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                low, high = sorted((top[i], top[j]))
                top = [low if t == high else t for t in top]
    want = [(i,) for i, t in enumerate(top) if i == t]
    assert len(set(prints)) > len(want) > 12  # some copies differ in bits
    assert rows(simhash.keep_one_of_each(table(spark, texts)).select("doc_id")) == sorted(want, key=str)


def test_token_counts_of_whole_texts(spark):
    texts = ODD + ["日本 語<0x0A> é</s> " * 3000, "ab" * 20_000, "a  b   c" * 5000]
    for path in (PIECES, WORDS):
        model = encoder(path)
        got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(table(spark, texts), path, chunk=5000).collect()}
        n = model.counts([t or "" for t in texts])
        assert got == {i: (len((t or "").encode()), k, k > 4096) for i, (t, k) in enumerate(zip(texts, n))}
    assert spliced_count(encoder(PIECES), prose(9, 3000), 64, 2) == encoder(PIECES).counts([prose(9, 3000)])[0]


def test_url_rules(spark):
    urls = ["http://A.org/x", "https://blog.example.org/es/1?q#f", "//none", None, "", "http://example.org", "http://x.com/de/", "http://myexample.org/es/", "http://example.org/es/", "http://example.org/es/", "http://org?x", "x://?"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit("clash"))
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("com", "/de/", "block"), ("com", "/de/", "allow")]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()}
    assert got[0] == ("a.org", "/x", "org/", "allow") and got[1] == ("blog.example.org", "/es/1", "example.org/es/", "block")
    assert got[2] == got[3] == got[4] == got[11] == ("", "", None, "allow") and got[5] == ("example.org", "", None, "allow")
    assert got[6][3] == "block" and got[7][2] == "org/" and got[8] == got[9] and got[10][0] == "org" and len(got) == len(urls)
    empty = spark.createDataFrame([], "host string, path string, verdict string")
    assert {r.verdict for r in judge_urls(pages, empty).collect()} == {"allow"}


def test_quality_ledger_keeps_columns_and_ablates(spark):
    docs = table(spark, [*ODD, "A a b c d e\na b c d e\n\na b c d e f", "SHOUT!! LOUD!! " * 20])
    judged = ledger(docs)
    assert judged.columns == [*docs.columns, "quality"] and rows(judged.select("doc_id", "w", "d")) == rows(docs.select("doc_id", "w", "d"))
    q = {r.doc_id: r.quality for r in judged.collect()}
    assert q[0].n_words == q[1].n_words == q[2].n_words == 0 and q[5].n_words == 30_001 and q[5].n_repeat_words == 0
    assert (q[8].n_words, q[8].n_repeat_words, q[8].n_dup_lines) == (17, 15, 0) and q[9].n_capital_words == 40
    assert rows(keep_good(docs).select("doc_id")) == [(5,), (6,), (7,)] and keep_good(docs).columns == docs.columns
    lines = {(r.policy, r.rule): r for r in ablation(judged).collect()}
    assert lines["v1", "few_words"].n_failed == 5 and lines["v1", "few_words"].n_kept == 3 and lines["v1", "few_words"].n_rows == 10


def test_leaks_copied_and_edited(spark):
    item = prose(11, 40)
    words = item.split()
    edited = words[:9] + ["changed"] + words[10:22] + ["put", "in"] + words[22:31] + words[33:]
    docs = table(spark, [f"{prose(1, 90)} {item.upper()} {prose(2, 90)}", f"{prose(3, 50)} {' '.join(edited)}", prose(4, 300), None, "", item, " ".join(words[:6])])
    bench = spark.createDataFrame([(1, item), (1, item), (2, prose(12, 30)), (3, None), (4, "two words")], "item_id long, text string")
    got = {r.doc_id: r for r in find_leaks(docs, bench).collect()}
    assert set(got) == {0, 1, 5} and got[0].similarity == 1.0 and (got[0].begin, got[0].end) == (90, 130) and 0.6 < got[1].similarity < 1
    assert find_leaks(docs, bench.limit(0)).count() == 0


def test_densely_edited_leaks_as_by_brute_force(spark):
    """A word changed in every 5 to 7, the last one too, so that no run of 2n - 1 words is untouched."""
    items = [prose(600 + k, 42) for k in range(9)]
    texts = []
    for k, item in enumerate(items):
        every = 5 + k % 3
        words = [f"new{k}x{i}" if i % every == 41 % every else w for i, w in enumerate(item.split())]
        texts.append(f"{prose(700 + k, 30)} {' '.join(words)} {prose(800 + k, 30)}")
    code = {}
    encode = lambda text: np.array([code.setdefault(w, len(code)) for w in text.lower().split()])
    want = {(i, k) for i, t in enumerate(texts) for k, item in enumerate(items) if alignment(encode(item), encode(t))[0] >= 0.6 * 2 * 42}
    assert len(want) == 9
    found = find_leaks(table(spark, texts), spark.createDataFrame(list(enumerate(items)), "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == want


def test_a_common_run_alone_brings_no_pairs(spark):
    """300 texts and 40 items share one phrase: only pairs that share more are aligned, and none of those is lost."""
    phrase = "in the middle of the night"
    items = [f"{prose(900 + k, 18)} {phrase} {prose(950 + k, 18)}" for k in range(40)] + [f"x{k} {phrase}" for k in range(3)]
    texts = [f"{prose(2000 + k, 40)} {phrase} {prose(2500 + k, 40)}" for k in range(300)]
    for k in range(12):  # edited copies of the first items, with the phrase and beside it
        words = items[k].split()
        texts[k] = f"{prose(3000 + k, 20)} {' '.join('changed' if i % 7 == 3 else w for i, w in enumerate(words))} {phrase}"
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    passages = leaks.passages_of(bench).withColumnRenamed("words", "body").cache()
    bits = spark.sparkContext.broadcast(leaks._filter_bits(passages.select(F.explode("seeds").alias("seed"))))
    hits = leaks.seed_hits(table(spark, texts), bits, "doc_id", "text", 60).cache()
    pairs = leaks.candidate_pairs(hits, passages)
    assert pairs.count() < 2000 < 300 * 40
    found = {(r.doc_id, r.item_id) for r in find_leaks(table(spark, texts), bench).collect()}
    code = {}
    encode = lambda text: np.array([code.setdefault(w, len(code)) for w in text.lower().split()])
    want = {(i, k) for i, t in enumerate(texts) for k, item in enumerate(items) if alignment(encode(item), encode(t))[0] >= min(0.6 * 2 * len(item.split()), 60)}
    assert found == want and len(want) > 600 and {(k, k) for k in range(12)} <= want


def test_copies_of_one_item_everywhere_are_found(spark):
    """Its seeds are in very many windows; edited copies and a long verbatim part are found all the same."""
    item = prose(41, 60)
    words = item.split()
    edited = [" ".join(f"e{k}" if i % 8 == k % 8 else w for i, w in enumerate(words)) for k in range(300)]
    long_item = prose(42, 250)
    part = " ".join(long_item.split()[100:140])
    docs = table(spark, [f"{prose(4000 + k, 10)} {e}" for k, e in enumerate(edited)] + [f"{prose(1, 50)} {part} {prose(2, 50)}"])
    bench = spark.createDataFrame([(1, item), (2, long_item), *((10 + k, item) for k in range(12))], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in find_leaks(docs, bench).collect()}
    assert {d for d, i in found if i == 1} == set(range(300)) and {d for d, i in found if i == 2} == {300}
    assert all({d for d, i in found if i == 10 + k} == set(range(300)) for k in range(12))


def test_alignment_is_smith_waterman():
    rng = np.random.default_rng(0)
    for _ in range(60):
        a, b = rng.integers(0, 4, rng.integers(1, 12)), rng.integers(0, 4, rng.integers(1, 16))
        h = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                h[i + 1, j + 1] = max(0, h[i, j] + (2 if a[i] == b[j] else -1), h[i, j + 1] - 1, h[i + 1, j] - 1)
        assert alignment(a, b)[0] == h.max()


def test_packing_places_every_token_once(spark):
    docs = table(spark, [*ODD, "<|ENDOFTEXT|> a<|endoftext|>", *(prose(k, 20 * k) for k in range(20))])
    packed = packed_documents(docs, WORDS, 512)
    pieces = token_pieces(docs, WORDS, 512, 1)
    got = packed.toPandas().sort_values(["sequence_id", "offset"])
    assert ((got.groupby("sequence_id").length.cumsum() - got.length) == got.offset).all() and got.groupby("sequence_id").length.sum().max() <= 512
    model = word_ids(WORDS).model
    want = {r.doc_id: [*model.encode(r.text or "", add_special_tokens=False).ids, 1] for r in docs.collect()}
    made = {}
    for r in pieces.orderBy("doc_id", "piece").collect():
        made.setdefault(r.doc_id, []).extend(np.frombuffer(bytes(r.ids), "<u4").tolist())
    assert made == want
    whole = sequences(packed, pieces).toPandas()
    assert sum(map(len, whole.ids)) == 4 * sum(map(len, want.values()))
    assert len(whole) <= 1.15 * sum(map(len, want.values())) / 512 + 1
    assert packed_documents(docs.limit(0), WORDS, 512).count() == 0


def test_remembered_words_have_the_ids_of_whole_texts(monkeypatch):
    """Plain Latin words go around the normaliser; capitals, composed letters and other scripts don't."""
    monkeypatch.setattr(packing, "_WORDS", 40)  # generations change all the time
    model = packing.WordIds(WORDS)
    assert model.plain is not None
    texts = ["École école ÉCOLE e\u0301cole straße ǆ ǅ aƻ ªb \u0130x iıi", "œuvre, naïve. don't x<|endoftext|> μ привет 你好 ﬁn a1b été!", *(prose(k, 30) for k in range(6))]
    for _ in range(2):
        for text in texts:
            want = np.asarray(model.model.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
            assert model.encode([text]) == [want]
    assert model.encode(texts) == [b"".join(model.encode([t])) for t in texts]


def test_nnls_solves():
    a = np.random.default_rng(1).random((12, 8))
    x = np.array([0, 1, 2, 0, 0, 3, 0, 0.5])
    assert np.allclose(nnls(a, a @ x), x, atol=1e-6)


def test_language_model_base_and_gain(spark):
    texts = [*ODD[:5], *(f"{'the cat sat on' if k % 2 else 'le chat dort la'} {prose(k % 9, 6)} " * 12 for k in range(80))]
    got = score_texts(table(spark, texts), known=5).toPandas().set_index("doc_id")
    import zlib
    from collections import Counter
    from math import log10

    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in range(len(texts))}
    tokens = {i: [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower()), "\n"] for i, t in enumerate(texts)}
    counts = Counter(w for i, t in tokens.items() if not held[i] for w in t)
    n, v = sum(counts.values()), len(counts)
    for i, t in tokens.items():
        r = got.loc[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(t), sum(counts[w] > 0 for w in t), n)
        assert abs(r.base_score - sum(log10((counts[w] + 1) / (n + v + 1)) for w in t)) < 1e-6
    assert np.isfinite(got.score).all() and (got.score < 0).all()


def test_toxicity_on_held_out_texts(spark):
    bad = ["grumble", "snarl"]
    texts = [f"{prose(k, 60)} {bad[k % 2]} {bad[k // 2 % 2]} {prose(k + 1000, 60)}" if k % 3 == 0 else prose(k, 120) for k in range(240)]
    docs = table(spark, [*texts, None, ""])
    labels = spark.createDataFrame([(k, 1, int(k % 3 == 0)) for k in range(240)], "doc_id long, quality int, toxic int")
    got = score_toxicity(docs, labels).toPandas()
    held = got[got.held_out & (got.doc_id < 240)]
    assert (held.predicted == (held.doc_id % 3 == 0)).mean() > 0.9 and got.score.between(0, 1).all() and len(got) == 242
    assert set(score_toxicity(docs, labels.limit(0)).toPandas().score) == {0.0}


def test_toxicity_keeps_class_shares_at_any_sample(spark):
    """A word of all toxic texts and of 30 % of the ordinary ones, eight times as many: likelier ordinary than toxic."""
    texts = [f"{prose(k, 12)} {'grumble' if k % 9 == 0 or k % 10 < 3 else 'rumble'} {prose(k + 5000, 12)}" for k in range(2000)]
    docs = table(spark, texts)
    labels = spark.createDataFrame([(k, 1, int(k % 9 == 0)) for k in range(2000)], "doc_id long, quality int, toxic int")
    shares = [score_toxicity(docs, labels, sample=n).agg(F.avg("predicted"), F.avg("score")).first() for n in (150, 4000)]
    assert abs(shares[0][0] - shares[1][0]) < 0.05 and abs(shares[0][1] - shares[1][1]) < 0.06


def test_secrets_by_ownership(spark):
    key, shared = "a1B2c3D4e5F6g7H8i9J0k1L2m3", "q9W8e7R6t5Y4u3I2o1P0a9S8d7"
    texts = ["password: hunter22 API_KEY='abcdefgh'", "token=short", f"AKIA{'A1' * 8} {'0f' * 20}", f"see {key} here", *[f"example {shared} is public"] * 8, None, "", "ſecret=abcdefghij é token = zzzzzzzzz"]
    got = {r.doc_id: r.found for r in scan_secrets(table(spark, texts)).collect()}
    spans = {i: [(s.kind, s.start, s.end) for s in f] for i, f in got.items()}
    assert spans[0] == [("assign", 0, 18), ("assign", 19, 36)] and spans[1] == [] and [s[0] for s in spans[2]] == ["access", "hex"]
    assert spans[3] == [("random", 4, 4 + len(key))] and all(spans[i] == [] for i in range(4, 14)) and [s[:2] for s in spans[14]] == [("assign", 20)]
    clean = {r.doc_id: r for r in redact(table(spark, texts)).collect()}
    assert clean[3].text == "see <secret> here" and shared in clean[5].text and clean[0].text == "<secret> <secret>'" and clean[12].text is None and clean[3].row == 7


def test_weak_labels_part_junk_from_prose(spark):
    junk = [" ".join(["same"] * 60), " ".join(w + "###" for w in prose(1, 60).split()), prose(2, 60).upper() + "!! " * 60, None, ""]
    texts = [*(prose(k, 90).replace(" a", ". a") for k in range(60)), *junk * 3]
    got = score_quality(table(spark, texts)).toPandas().sort_values("doc_id")
    assert got.kept[:60].mean() > 0.95 and not got.kept[60:].any() and got.score.between(0, 1).all()
