"""The training-data operators against brute force on small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from changeflow.llm import (
    chat_format, components, digest_index, fingerprints, hidden_markov, jaccard_join, license_scan,
    mixing, piece_codec, quality_model, queries, url_filter, words,
)

DOCS = "doc_id bigint, text string"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingles(text, k):
    w = tokens(text)
    return {tuple(w[i : i + k]) for i in range(max(len(w) - k + 1, 1))} if w else set()


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and clashing column names."""
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    rows = [
        (1, "A b c d e", "s", 1), (1, "A b c d e", "s", 1), (2, "a b c d e", None, 2), (3, None, "s", 3),
        (4, "", "s", 4), (None, "lone text", None, 5), (5, long, "t", 6), (6, long + " end", "t", 7),
        (7, " \t\n ", "t", 8), (8, "x", "t", 9),
    ]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, n bigint")


@pytest.fixture(scope="module")
def documents(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


# --- words ----------------------------------------------------------------------


def test_shingles_are_those_of_a_plain_split():
    texts = ["The cat sat on the MAT", None, "", "a b", "  A  B ", "é ü é ü é ü", "one"]
    found = list(words.distinct_shingles(pa.array(texts), 4))
    assert [len(x) for x in found] == [len(shingles(t, 4)) for t in texts]
    assert (found[3] == found[4]).all()


# --- 1: pieces ------------------------------------------------------------------


@pytest.mark.parametrize("check", ["words", "texts"])
def test_ids_are_the_librarys(check):
    codec = piece_codec.PieceCodec(public_tokenizers.path(queries.VOCABULARY), check)
    texts = [
        "", " ", "  a  b ", "x▁y", "▁", "\n", "日本語 テキスト", "</s>[INST] ok", "\x00", "a" * 500,
        "🙂🙂 z", "<0x41> <s>", "ab" * 500 + " " * 50 + "x", "Ein Satz, mit Zeichen.",
    ]
    for text in texts:
        ids = codec.encode(text)
        assert ids == (codec.library.encode(text, add_eos=True) if text else [2])
        assert codec.decode(ids) == codec.library.decode(ids)


def test_without_cuts_whole_texts_go_through_the_agenda():
    codec = piece_codec.PieceCodec(public_tokenizers.path(queries.VOCABULARY), "texts")
    codec.cuts_at_mark = False
    assert codec.encode("some words  here") == codec.library.encode("some words  here", add_eos=True)


def test_piece_digests(odd):
    found = piece_codec.piece_digests(odd, public_tokenizers.path(queries.VOCABULARY))
    rows = {r.doc_id: r for r in found.collect()}
    assert found.count() == 10
    assert (rows[4].n_tokens, rows[4].ids_sha256) == (1, hashlib.sha256(b"2").hexdigest())
    assert rows[3].ids_sha256 == rows[4].ids_sha256
    assert piece_codec.piece_digests(odd.limit(0), public_tokenizers.path(queries.VOCABULARY)).count() == 0


def test_digests_of_all_documents_are_the_librarys(spark, small, documents):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(queries.VOCABULARY))
    want = set()
    for row in documents.select("doc_id", "text").collect():
        ids = library.encode(row.text or "") + [library.eos_id()]
        shown = (" ".join(map(str, ids)), library.decode(ids))
        want.add((row.doc_id, len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in shown)))
    got = queries.op1_sentencepiece(spark, small).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert {tuple(r) for r in got.collect()} == want


# --- 2: exact dedup --------------------------------------------------------------


def test_exact_dedup(odd):
    rows = digest_index.exact_dedup(odd).collect()
    kept = {(r.doc_id, r.keep_id, r.group_size) for r in rows if r.kept}
    assert kept == {(2, 2, 3), (4, 4, 2), (None, None, 1), (5, 5, 1), (6, 6, 1), (7, 7, 1), (8, 8, 1)}
    assert len(rows) == 10
    assert digest_index.exact_dedup(odd.limit(0)).count() == 0
    left = digest_index.keep_first_copies(odd)
    assert left.columns == odd.columns and left.count() == 7


def test_index_keeps_earlier_deliveries(spark, odd, fresh):
    index = digest_index.DigestIndex(spark, fresh())
    digest_index.exact_dedup(odd.where("doc_id = 1"), index=index).count()
    later = digest_index.exact_dedup(odd.where("doc_id IN (2, 8)"), index=index).collect()
    assert {(r.doc_id, r.keep_id, r.kept) for r in later} == {(2, 1, False), (8, 8, True)}
    assert index.read().count() == 2
    index.close()


def test_index_lives_on_in_another_session(spark, odd, fresh):
    path, other = fresh(), spark.newSession()
    first = digest_index.DigestIndex(spark, path, buckets=4)
    digest_index.exact_dedup(odd.where("doc_id IN (1, 5)"), index=first).count()
    first.close()
    again = digest_index.DigestIndex(other, path, buckets=64)
    assert again.exists() and again.buckets == 4
    docs = other.createDataFrame([(9, "a B C d e"), (10, "new")], DOCS)
    for _ in range(2):  # a run that is done again finds what has landed
        rows = digest_index.exact_dedup(docs, index=again).collect()
        assert {(r.doc_id, r.keep_id, r.kept) for r in rows} == {(9, 1, False), (10, 10, True)}
        assert again.read().count() == 3
    plan = again.read().join(docs.select(F.unhex(F.sha2("text", 256)).alias("digest")).hint("merge"), "digest")
    assert "SelectedBucketsCount: 4 out of 4" in plan._jdf.queryExecution().executedPlan().toString()
    again.close()


def test_first_append_that_failed_leaves_an_empty_index(spark, odd, fresh):
    index = digest_index.DigestIndex(spark, fresh(), buckets=4)
    bad = digest_index.with_digest(odd).withColumn("doc_id", F.raise_error("lost").cast("bigint"))
    with pytest.raises(Exception, match="lost"):
        index.append_new(bad)
    again = digest_index.DigestIndex(spark, index.path)
    assert again.read().count() == 0
    rows = digest_index.exact_dedup(odd, index=again).collect()
    assert sum(r.kept for r in rows) == 7
    index.close()
    again.close()


def test_the_query_leaves_no_table_in_the_catalog(spark, odd):
    before = {t.name for t in spark.catalog.listTables()}
    assert digest_index.exact_dedup(odd).count() == 10
    assert {t.name for t in spark.catalog.listTables()} == before


# --- 3: urls ---------------------------------------------------------------------


def test_rules(spark):
    urls = {
        "http://WWW.Example.com/en/x?a": ("www.example.com", "/en/x", "www.example.com/en/", "allow"),
        "http://m.example.com/en/1#t": ("m.example.com", "/en/1", "example.com/en/", "block"),
        "https://example.com/fr/1": ("example.com", "/fr/1", "com/", "allow"),
        "http://a.net/es/1": ("a.net", "/es/1", "net/es/", "block"),
        "http://a.com": ("a.com", "", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    pages = spark.createDataFrame([(i, u, None, "x") for i, u in enumerate(urls)], "page_id int, url string, html string, rule string")
    found = url_filter.filter_urls(pages, queries.RULES).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in found] == list(urls.values())
    assert url_filter.filter_urls(pages.limit(0), queries.RULES).count() == 0


def test_distrust_goes_against_links(spark):
    page = '<a class="x" href="{}">t</a>'
    pages = spark.createDataFrame(
        [
            (1, "http://bad.net/es/1", ""), (2, "http://farm.org/a", page.format("http://bad.net/es/1")),
            (3, "http://good.com/a", page.format("https://friend.org/")), (4, "http://friend.org/b", None),
            (5, "http://other.org/c", page.format("/here")),
        ],
        "page_id int, url string, html string",
    )
    found = {r.page_id: (r.verdict, r.trust, r.distrust) for r in url_filter.filter_urls(pages, queries.RULES).collect()}
    assert {i: v[0] for i, v in found.items()} == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "allow"}
    assert found[2][2] == pytest.approx(0.15 * 0.85) and found[4][1] == pytest.approx(0.15 * 0.85)


def test_parent_domains_carry_scores_that_no_page_is_on(spark):
    hosts = ["a.b.bad.net", "m.bad.net", "x.farm.co.uk", "y.other.co.uk", "10.0.0.1", "10.1.0.1", "w.port.org:80"]
    pages = spark.createDataFrame(
        [(i, f"http://{h}/{'es' if i == 0 else 'xx'}/1", '<a href="/de">x</a>') for i, h in enumerate(hosts)],
        "page_id int, url string, html string",
    )
    edges = {(r.src, r.dst) for r in url_filter.host_links(pages).collect()}
    up = {
        ("a.b.bad.net", "b.bad.net"), ("b.bad.net", "bad.net"), ("m.bad.net", "bad.net"),
        ("x.farm.co.uk", "farm.co.uk"), ("y.other.co.uk", "other.co.uk"),
        ("w.port.org:80", "w.port.org"), ("w.port.org", "port.org"),
    }
    assert edges == up | {(b, a) for a, b in up}
    total = Counter(b for _, b in edges)
    score = start = {"a.b.bad.net": 0.15}
    for _ in range(12):
        sent = Counter(start)
        for a, b in edges:  # distrust goes from dst to src
            sent[a] += 0.85 * score.get(b, 0) / total[b]
        score = sent
    found = {r.host: r for r in url_filter.filter_urls(pages, queries.RULES).collect()}
    assert {h: r.distrust for h, r in found.items()} == pytest.approx({h: score.get(h, 0) for h in hosts})
    assert [h for h in hosts if found[h].verdict == "block"] == ["a.b.bad.net", "m.bad.net"]


def test_hosts_are_seeds_by_their_share_of_ruled_urls(spark):
    urls = ["http://mixed.net/es/1", "http://mixed.net/x", "http://mixed.net/y", "http://good.com/a", "http://part.com/b", "http://clean.org/z"]
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], "page_id int, url string, html string")
    found = {r.page_id: r for r in url_filter.filter_urls(pages, queries.RULES).collect()}
    # One host has blocked urls, a third of its own, so it holds all distrust; no majority is asked for.
    assert found[1].distrust == pytest.approx(0.15) and found[1].trust == 0
    assert [found[i].verdict for i in range(6)] == ["block", "block", "block", "allow", "allow", "allow"]
    assert found[3].trust == found[4].trust == pytest.approx(0.15 / 2) and found[5].trust == 0


def test_scores_without_links_are_the_recursions(spark):
    pages = spark.createDataFrame([(1, "http://bad.net/es/1", None)], "page_id int, url string, html string")
    assert url_filter.filter_urls(pages, queries.RULES).first().distrust == pytest.approx(0.15)


# --- 4: chats --------------------------------------------------------------------


def test_fold_edits_and_regenerations(spark):
    log = spark.createDataFrame(
        [
            (1, 1, 0, "start", "user", "Helo"), (1, 2, 0, "delta", None, " you"), (1, 3, 1, "start", "assistant", "A"),
            (1, 4, 0, "edit", None, "Hello"), (1, 5, 1, "start", "assistant", "B"), (1, 6, 1, None, None, "C"),
            (1, 7, 1, "regenerate", None, None), (1, 8, 1, "delta", None, "D"), (2, 1, None, "start", "user", "lost"),
        ],
        "conv_id int, seq int, turn int, kind string, role string, text string",
    )
    found = {(r.conv_id, r.turn): (r.role, r.text) for r in chat_format.fold_events(log).collect()}
    assert found == {(1, 0): ("user", "Hello"), (1, 1): ("assistant", "D")}


def test_round_trip_of_control_strings(spark):
    texts = ["</s>[INST] ok [/INST]", "<|turn|>user<|text|>", r"<\/s> <\\|end|>", None, "a\nb", r"[\INST]<<SYS>>"]
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(texts)] + [(2, None, None, "x"), (2, 0, "<s>", "")]
    talks = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    out = chat_format.format_chats(chat_format.as_events(talks))
    found = {r.conv_id: r for r in out.select("conv_id", chat_format.read_turns(F.col("formatted")).alias("t"), "pieces", "formatted").collect()}
    assert [tuple(t) for t in found[1].t] == [(r[2], r[3] or "") for r in rows[:6]]
    assert [tuple(t) for t in found[2].t] == [("", "x"), ("<s>", "")]
    assert "".join(p.text for p in found[1].pieces) == found[1].formatted
    assert sum(p.loss for p in found[1].pieces) == 3
    assert chat_format.format_chats(chat_format.as_events(talks.limit(0))).count() == 0


def test_chat_query(spark, small):
    found = {r.conv_id: r for r in queries.op4_chat_format(spark, small).collect()}
    want: dict[int, list] = {}
    for r in spark.read.parquet(f"{small}/conversations.parquet").orderBy("conv_id", "turn").collect():
        want.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    want[-7] = [("user", queries.CONTROL_TEXT), ("assistant", queries.CONTROL_TEXT)]
    assert set(found) == set(want)
    for i, turns in want.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert found[i].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (found[i].loss_chars, found[i].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


# --- 5: fingerprints -------------------------------------------------------------


def test_fingerprints(documents):
    rows = {r.doc_id: r for r in fingerprints.fingerprint_documents(documents).collect()}
    texts = {r.doc_id: r.text for r in documents.collect()}
    order = sorted(texts, reverse=True)
    off = []
    for i, doc in enumerate(order):
        text, after = texts[doc], texts[order[(i + 1) % len(order)]]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert rows[doc].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b = (set(zip(*[t.split()[j:] for j in range(5)])) for t in (text, edited))
        if len(a) > 50:
            off.append(rows[doc].near_edited - len(a & b) / len(a | b))
    assert np.abs(off).mean() < 0.05 and abs(np.mean(off)) < 0.02


def test_odd_fingerprints(odd):
    rows = fingerprints.fingerprint_documents(odd).collect()
    assert len(rows) == 10
    by_id = {r.doc_id: r for r in rows}
    assert by_id[3].fingerprint == by_id[4].fingerprint == by_id[7].fingerprint == ""
    assert by_id[1].fingerprint != by_id[2].fingerprint and by_id[5].near_next < 0.1
    assert fingerprints.fingerprint_documents(odd.limit(0)).count() == 0


# --- 6: mixing -------------------------------------------------------------------


def test_every_prefix_is_within_a_block_of_its_share():
    weights = {"a": 0.5, "b": 0.3, "c": 0.137, "d": 0.063}
    quota = mixing.quotas(weights, 1000)
    period = sum(quota.values())
    slots = mixing.edf_period(quota)
    assert sorted(np.concatenate(list(slots.values()))) == list(range(period))
    for name, own in slots.items():
        for t in range(period + 1):
            given = int(np.searchsorted(own, t))
            assert abs(given - Fraction(quota[name] * t, period)) < 1


def ideal_mixture(blocks, weights, slot):
    """What each source has of so many slots if blocks could be divided; who runs out leaves."""
    given, left = dict.fromkeys(blocks, Fraction(0)), Fraction(slot)
    while left:
        open_ = [n for n in blocks if given[n] < blocks[n]]
        total = sum(Fraction(weights[n]) for n in open_)
        step = min(left, *((blocks[n] - given[n]) * total / Fraction(weights[n]) for n in open_))
        for n in open_:
            given[n] += step * Fraction(weights[n]) / total
        left -= step
    return given


def test_prefixes_keep_to_the_weights_themselves():
    hot = {"hot": 1700, **{f"s{i:02}": 85 for i in range(20)}}
    uneven = {"a": 900, "b": 37, "c": 1, "d": 411}
    cases = [
        (hot, {n: float(b) ** 0.5 for n, b in hot.items()}),
        (uneven, {"a": 0.61803, "b": 0.0002, "c": 0.1, "d": 1 / 3}),
        ({"a": 3000, "b": 3}, {"a": 0.9998, "b": 0.0002}),
    ]
    for blocks, weights in cases:
        slots = list(mixing.schedule(blocks, weights))
        assert sorted(slots) == sorted((n, j) for n, b in blocks.items() for j in range(b))
        given = Counter()
        for t, (n, j) in enumerate(slots, 1):
            assert j == given[n]  # in order
            given[n] += 1
            if t % 7 == 0 or t > len(slots) - 50:
                for name, ideal in ideal_mixture(blocks, weights, t).items():
                    assert abs(given[name] - ideal) < 1


def test_ranges_of_the_schedule_follow_each_other(spark):
    rows = {"a": 50, "b": 7, "c": 1}
    plan = mixing.plan_of_blocks(spark, rows, {"a": 0.7, "b": 0.2, "c": 0.1}, 4, range_slots=5).orderBy("slot").collect()
    assert [(r.source, r.block) for r in plan] == list(mixing.schedule({"a": 13, "b": 2, "c": 1}, {"a": 0.7, "b": 0.2, "c": 0.1}))
    sizes = [min(4, rows[r.source] - 4 * r.block) for r in plan]
    assert [r.start for r in plan] == [sum(sizes[:i]) for i in range(len(plan))]


def test_mixing_places_each_row_once(documents, odd):
    for docs, n in ((documents, documents.count()), (odd, 10)):
        rows = mixing.mix_sources(docs, block_rows=4).collect()
        assert sorted(r.position for r in rows) == list(range(n))
    assert mixing.mix_sources(odd.limit(0)).count() == 0
    mixed = mixing.in_mixed_order(documents)
    assert mixed.columns == documents.columns
    assert sorted(r.doc_id for r in mixed.collect()) == sorted(r.doc_id for r in documents.collect())


# --- 7: quality ------------------------------------------------------------------


def test_sum_of_squares_is_the_sum_over_pairs():
    model = quality_model.FactorisationMachine(20, rank=3)
    model.factors[:] = np.random.default_rng(1).normal(size=model.factors.shape)
    model.single[:] = np.random.default_rng(2).normal(size=20)
    index, value = np.array([1, 4, 9]), np.array([0.5, -1.0, 2.0], np.float32)
    x = quality_model.Features(np.array([0, 3]), index, value)
    want = (model.single[index] * value).sum()
    for i in range(3):
        for j in range(i + 1, 3):
            want += model.factors[index[i]] @ model.factors[index[j]] * value[i] * value[j]
    assert model.sums(x)[0][0] == pytest.approx(want, rel=1e-4)


def test_held_out_quality(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = queries.op7_quality(spark, folder).collect()
    quality = {r.doc_id: r.quality for r in labels.collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    judged = [r for r in rows if r.held_out and r.doc_id in quality]
    assert np.mean([r.predicted == quality[r.doc_id] for r in judged]) > 0.95


def test_odd_quality(spark, odd):
    none = spark.createDataFrame([(None, 1), (3, None)], "doc_id bigint, quality int")
    rows = quality_model.score_quality(odd, none, metadata=["n"]).collect()
    assert len(rows) == 10 and all(r.score == 0.5 for r in rows)
    assert quality_model.score_quality(odd.limit(0), none).count() == 0


# --- 8: language model -----------------------------------------------------------


def test_lm_counts_and_likelihood(documents):
    rows = hidden_markov.score_texts(documents).collect()
    texts = {r.doc_id: tokens(r.text) + ["\n"] for r in documents.collect()}
    count = Counter()
    for i, own in texts.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            count.update(own)
    n, v = sum(count.values()), len(count)
    for r in rows:
        own = texts[r.doc_id]
        base = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in own)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(count[w] > 0 for w in own), n)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_forward_sums_over_all_paths():
    share = np.full(5, 0.2)
    model = hidden_markov.Model.random(5, share)
    classes, bounds = np.array([1, 3, 0, 4, 0]), np.array([0, 3, 5])
    want = []
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        p = model.start * model.emit[classes[lo]]
        for c in classes[lo + 1 : hi]:
            p = np.array([sum(p[i] * model.move[i, j] for i in range(len(p))) for j in range(len(p))]) * model.emit[c]
        want.append(math.log(p.sum()))
    assert hidden_markov.likelihoods(model, classes, bounds) == pytest.approx(want)
    start, moves, counts = hidden_markov.expected_counts(model, classes, bounds)
    assert (start.sum(), moves.sum(), counts.sum()) == pytest.approx((2, 3, 5), rel=1e-4)


def test_odd_texts_have_scores(odd):
    rows = hidden_markov.score_texts(odd).collect()
    assert len(rows) == 10 and all(math.isfinite(r.score) and r.score < 0 for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (3, 4, 7)} == {1}
    assert hidden_markov.score_texts(odd.limit(0)).count() == 0


# --- 9: similar documents --------------------------------------------------------


def brute_components(texts, percent, k):
    ids = list(texts)
    sets = {i: shingles(texts[i], k) for i in ids}
    label = {i: i for i in ids}
    links = [
        (a, b) for a in ids for b in ids
        if a < b and sets[a] and sets[b]
        and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    moved = True
    while moved:
        moved = False
        for a, b in links:
            low = min(label[a], label[b])
            moved |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


@pytest.mark.parametrize("percent,k", [(85, 4), (80, 5)])
def test_components_match_brute_force(spark, percent, k):
    draw = np.random.default_rng(5)
    common = " ".join(f"c{j}" for j in range(60))
    texts = {}
    for i in range(160):
        kind = i % 4
        own = [f"w{draw.integers(0, 40 if kind == 1 else 5000)}" for _ in range(draw.integers(1, 90))]
        if kind == 2:
            own = common.split() + own[:20]
        if kind == 3:
            own = texts[int(draw.integers(0, i))].split() or ["x"]
            for _ in range(draw.integers(0, 3)):
                own[draw.integers(0, len(own))] = "edited"
        texts[i] = " ".join(own)
    docs = spark.createDataFrame(list(texts.items()), DOCS)
    found = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(docs, percent, k).collect()}
    assert found == brute_components(texts, percent, k)


def almost_linked(count: int) -> dict[int, str]:
    """Texts that pairwise have 300 of 376 words in common, just too few, and one that links with two of them."""
    common = " ".join(f"c{j}" for j in range(300))
    texts = {i: f"{common} " + " ".join(f"w{i}_{j}" for j in range(38)) for i in range(count)}
    texts[count] = f"{common} " + " ".join(f"w{i}_{j}" for i in (7, 8) for j in range(19))
    return texts


def test_pairs_between_groups_grow_with_the_documents(spark, monkeypatch):
    texts, counts = almost_linked(60), []

    def verified(docs, pairs, *how, own=jaccard_join._verified):
        counts.append(pairs.count())
        return own(docs, pairs, *how)

    monkeypatch.setattr(jaccard_join, "_verified", verified)
    docs = spark.createDataFrame(list(texts.items()), DOCS)
    found = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(docs, 80, 1).collect()}
    assert found == brute_components(texts, 80, 1)
    assert found[60] == found[8] == 7 and len(set(found.values())) == 59
    assert max(counts) <= len(texts)


def test_sketches_of_much_larger_sets_are_folded(spark):
    """A linked pair with sketches of 1 and 4 words, its common shingles in the last two."""
    pool = np.random.default_rng(3).integers(0, 1 << 63, 20_000, dtype=np.uint64)
    place = (words.mix(pool) >> np.uint64(8)).astype(np.int64) & 255
    at = {int(p): pool[i] for i, p in enumerate(place)}
    small = np.array([at[128 + i] for i in range(32)])
    big = np.concatenate([small, [at[32 + i] for i in range(32)], [at[96]]])
    rows = [
        (7, i, i, 2, len(own), bytearray(jaccard_join.whole_sketch(own).tobytes())) for i, own in enumerate((small, big))
    ]
    grouped = spark.createDataFrame(rows, "group bigint, id bigint, comp bigint, side int, n bigint, whole binary")
    found = jaccard_join._candidates(grouped.coalesce(1), 49, False).collect()
    assert [(r.id, r.hub) for r in found] == [(1, 0)]


@pytest.mark.parametrize("percent", [45, 20])
def test_components_of_low_percents_match_brute_force(spark, percent):
    draw = np.random.default_rng(9)
    texts = {}
    for i in range(60):
        words_ = [f"g{i // 6}_{j}" for j in range(int(draw.integers(10, 160)))]
        texts[i] = " ".join(words_)
    docs = spark.createDataFrame(list(texts.items()), DOCS)
    found = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(docs, percent, 3).collect()}
    assert found == brute_components(texts, percent, 3)


def test_linked_sets_share_a_key_that_neither_leaves():
    """With any choice of spare keys: more keys are shared than the roomier set may leave."""
    draw = np.random.default_rng(5)
    bands = jaccard_join.Bands(85)
    checked = sparse = 0
    for n in (6, 13, 20, 22, 26, 40):
        for _ in range(1500):
            pool = draw.integers(0, 1 << 63, 2 * n, dtype=np.uint64)
            gone = int(draw.integers(0, n // 5 + 1))
            a, b = pool[:n], pool[gone : n + int(draw.integers(0, n // 5 + 1))]
            common = len(np.intersect1d(a, b))
            if 100 * common < 85 * len(np.union1d(a, b)):
                continue
            checked += 1
            band = bands.band_of(min(len(a), len(b)))
            assert band in bands.bands_of(len(a)) and band in bands.bands_of(len(b))
            of_a, of_b = (jaccard_join.block_keys(x, band, bands) for x in (a, b))
            sparse += len(of_a) > 1 or len(of_b) > 1
            shared = [
                len(np.intersect1d(keys_a, keys_b)) - max(room_a, room_b)
                for _, room_a, keys_a in of_a for _, room_b, keys_b in of_b
            ]
            assert max(shared) > 0
    assert checked > 1000 and sparse > 20


@pytest.mark.parametrize("parts", [1, 7, 64])
def test_packed_keys_come_out_as_they_went_in(spark, parts):
    """Whatever the number of parts, negative and far ids, and a key of all ids."""
    draw = np.random.default_rng(3)
    ids = [-(1 << 62), -5, 0, 7, 8, 1 << 62, 3]
    keys = [np.append(draw.integers(0, 1 << 64, 50, dtype=np.uint64), np.uint64(99)) for _ in ids]
    of = [np.full(len(k), i, dtype=np.int64) for i, k in zip(ids, keys)]
    batch = jaccard_join._packed(of, keys, parts)
    assert batch.num_rows <= parts and max(batch.column("part").to_pylist()) < parts
    packed = spark.createDataFrame(pa.Table.from_batches([batch])).select("part", "packed")
    found = {(r.key, r.id) for r in jaccard_join._unpacked(packed, parts).collect()}
    assert found == {(int(k.view(np.int64)), i) for i, own in zip(ids, keys) for k in own}
    shared = jaccard_join._shared(packed, parts).collect()
    assert {(r.key, r.id, r.hub, r.members) for r in shared} == {(99, i, min(ids), len(ids)) for i in ids}


@pytest.mark.parametrize("many", [200_000, 12])
def test_one_key_for_the_same_members_brings_all_pairs(spark, monkeypatch, many):
    """Against all keys that a set keeps; with keys whose rows are sent on in parts, too."""
    monkeypatch.setattr(jaccard_join, "MANY", many)
    draw = np.random.default_rng(many)
    groups = [draw.choice(40, draw.integers(1, 25), replace=False) for _ in range(60)]
    ids, keys, members = [], [], {}
    for number in range(400):
        key = np.uint64(int(draw.integers(0, 1 << 50)) | int(draw.integers(3, 5)) << jaccard_join.HASH_BITS)
        own = groups[draw.integers(0, len(groups))]
        members[int(key.view(np.int64))] = set(own.tolist())
        for i in own:
            ids.append(np.full(1, i, dtype=np.int64))
            keys.append(np.full(1, key, dtype=np.uint64))
    rooms = {(i, code): int(draw.integers(0, 30)) for i in range(40) for code in (3, 4)}
    kept: dict[int, set[int]] = {}
    for (i, code), room in rooms.items():
        own = [k for k, m in members.items() if i in m and len(m) > 1 and k >> jaccard_join.HASH_BITS == code]
        for key in sorted(own, key=lambda k: (-min(len(members[k]), many), k))[room:]:
            kept.setdefault(key, set()).add(i)
    packed = spark.createDataFrame(pa.Table.from_batches([jaccard_join._packed(ids, keys, 3)])).select("part", "packed")
    of_rooms = spark.createDataFrame([(i, code, n) for (i, code), n in rooms.items()], "id bigint, code int, n bigint")
    rows = jaccard_join._needed(jaccard_join._shared(packed, 3), of_rooms).collect()
    found: dict[int, set[int]] = {}
    for r in rows:
        found.setdefault(r.key, set()).add(r.id)
        assert r.hub == min(members[r.key])
    pairs = [{(a, b) for m in by_key.values() for a in m for b in m} for by_key in (kept, found)]
    assert pairs[0] == pairs[1]
    assert sum(r["keys"] for r in rows) == sum(map(len, kept.values())) >= len(rows)
    assert many == 12 or len(rows) < sum(map(len, kept.values())) / 2


def test_odd_components(odd):
    rows = jaccard_join.jaccard_components(odd).collect()
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in rows}
    assert len(rows) == 10
    assert found[1] == found[1] and found[2] == (2, 1) and found[3] == (0, 3) and found[None][1] is None
    assert found[6][1] == 5
    assert jaccard_join.jaccard_components(odd.limit(0)).count() == 0
    left = jaccard_join.keep_one_of_each(odd)
    assert sorted((r.doc_id or 0) for r in left.collect()) == [0, 1, 1, 3, 4, 5, 7, 8]


def test_chain_is_one_component(spark):
    links = spark.createDataFrame([(i + 1, i) for i in range(40)] + [(100, 101), (7, 7)], "id bigint, hub bigint")
    found = {r.id: r.component for r in components.connected_components(links).collect()}
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


# --- 10: licenses ----------------------------------------------------------------


def test_licenses_match_brute_force(documents, spark):
    wanted = {n: shingles(t, 5) for n, t in license_scan.NOTICES.items()}
    long = license_scan.NOTICES["MIT-permission"]
    planted = spark.createDataFrame(
        [(-1, "some words before it " + long.upper() + " and after"), (-2, long.replace("merge", "join")), (-3, None), (-4, "MIT")], DOCS
    )
    docs = documents.select("doc_id", "text").unionByName(planted)
    for r in license_scan.scan_licenses(docs).join(docs, "doc_id").collect():
        own = shingles(r.text, 5)
        want = [n for n, s in sorted(wanted.items()) if 100 * len(s & own) >= 80 * len(s)]
        assert [x.name for x in r.licenses] == want, r.doc_id
    assert license_scan.scan_licenses(docs.limit(0)).count() == 0
    assert license_scan.scan_licenses(docs, {}).where("n_licenses > 0").count() == 0


def test_licenses_without_marks_in_comments_and_in_full(spark):
    notices = license_scan.NOTICES
    comment = "\n".join(f" * {line}" for line in re.findall(r".{1,60}(?:\s|$)", notices["MPL-2.0-header"]))
    header = re.sub(r"(\S+ \S+ \S+) ", r"\1\n# ", "# " + notices["Apache-2.0-header"].replace('"', "\u201c"))
    texts = {
        "released under the MIT License, see below": "MIT",
        "x (Released under the MIT License) y": "MIT",
        "so licensed under CC BY-NC 4.0, as said": "CC-BY-NC-4.0",
        "text. Licensed under CC BY-SA 4.0": "CC-BY-SA-4.0",
        "// SPDX-License-Identifier: BSD-3-Clause\nint x;": "BSD-3-Clause-spdx",
        "see the GNU Lesser General Public License version 2.1 or so": "LGPL-2.1-name",
        "code();\n" + comment: "MPL-2.0-header",
        header + "\nimport x": "Apache-2.0-header",
        "word " * 40 + notices["AGPL-3.0-header"]: "AGPL-3.0-header",
        **{"My project\n" + notices[n]: n for n in notices if n.endswith("-text")},
    }
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS)
    found = {r.doc_id: {x.name: x for x in r.licenses} for r in license_scan.scan_licenses(docs).collect()}
    for i, (text, name) in enumerate(texts.items()):
        assert name in found[i], (text[:60], sorted(found[i]))
    assert found[1]["MIT"].first_word == 1 and found[8]["AGPL-3.0-header"].first_word == 40
    assert "GPL-2.0-name" not in found[5] and "CC-BY-4.0" not in found[2]


def test_short_notices_are_retrieved_by_any_shingle(spark):
    template = {"t": "one two three four five six seven"}
    docs = spark.createDataFrame([(1, "one two three four five and six seven"), (2, "two three four five six")], DOCS)
    found = license_scan.scan_licenses(docs, template, percent=30).orderBy("doc_id").collect()
    assert [r.licenses[0].containment for r in found] == [pytest.approx(1 / 3)] * 2
