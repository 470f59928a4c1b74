"""Each method against brute force, an exact round trip, or the library it must equal."""

import random

import numpy as np
import pytest

from linkwright.llm import decontamination as dc
from linkwright.llm import language_id as li
from linkwright.llm import media, packing, simhash, substring_dedup, suffix_sort, token_files
from linkwright.llm.common import encoder, tokenizer_path
from linkwright.llm.token_counts import SPACE, UnigramCounter, vocabulary


def test_codec_round_trip_and_checkpoints():
    r = np.random.default_rng(1)
    ids = (r.zipf(1.3, 300_000) % 40_000).astype(np.uint32)
    codec = token_files.Codec(token_files.frequency_table(np.bincount(ids, minlength=50_000)))
    for n in (0, 1, 7, 300, len(ids)):
        raw = codec.encode(ids[:n], lanes=256)
        assert (codec.decode(raw) == ids[:n]).all()
    marks = token_files.HEAD.unpack_from(raw)[3]
    assert marks > 3
    assert (codec.decode(raw, 2) == ids[2 * token_files.CHECKPOINT_STEPS * 256 :]).all()
    broken = bytearray(raw)
    broken[-5] ^= 1
    with pytest.raises(ValueError):
        codec.decode(bytes(broken))
    with pytest.raises(ValueError):
        codec.encode(np.array([49_999], dtype=np.uint32))


def test_plan_fills_every_slot_once():
    r = random.Random(2)
    for context in (16, 50):
        for _ in range(30):
            hist = {r.randint(1, context): r.randint(1, 40) for _ in range(r.randint(1, 12))}
            ranks, used = {}, {}
            for length, rank, count, first, items, offset in packing.plan(hist, context):
                ranks.setdefault(length, []).extend(range(rank, rank + count))
                for i in range(count):
                    used.setdefault(first + i // items, []).append((offset + i % items * length, length))
            assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in hist.items()}
            for spans in used.values():
                at = 0
                for start, length in sorted(spans):
                    assert start == at
                    at += length
                assert at <= context
            assert sorted(used) == list(range(len(used)))


def test_words_encode_as_whole_texts():
    enc = encoder(tokenizer_path())
    odd = ["A), b.", "foo_, bar. Baz", "İstanbul Σίσυφος, ΑΣ. x", "a\x1cb, c", "<|endoftext|> x", "x́, y", "'s, don't. I'LL, ", "| a|b, |", "", " ", "日本語、テスト。 ok", "éte, a .. b", "x" * 500 + ", y", "1,000.5 a1, 2. ½, ²."]
    for together in (odd, *[[t] for t in odd]):
        assert [i.tolist() for i in enc.encode(list(together))] == [enc._ids(t) for t in together]


def test_counts_equal_the_library():
    from tokenizers import Tokenizer, models, pre_tokenizers

    def library(pieces):
        t = Tokenizer(models.Unigram([("<unk>", -1.0), *pieces], 0))
        t.pre_tokenizer = pre_tokenizers.Metaspace(replacement=SPACE, prepend_scheme="always", split=True)
        return lambda x: len(t.encode(x, add_special_tokens=False).ids)

    tied = [("a", -1.0), ("b", -1.0), ("ab", -2.0), ("aba", -3.0), (SPACE, -1.0), (SPACE + "a", -2.0), ("ba", -2.0), ("bb", -1.5)]
    r = random.Random(3)
    count, want = UnigramCounter(tied).count, library(tied)
    for _ in range(3000):
        x = "".join(r.choice("aabbc d") for _ in range(r.randint(0, 12)))
        assert count(x) == want(x)
    real = vocabulary(tokenizer_path("piece_bpe_32k.model"))
    count, want = UnigramCounter(real).count, library(real)
    for x in ["", " ", "  a", "The quick  brown\nfox ", "日本 ☃☃ x☃y", "▁a▁", "a\x00b", "antidisestablishmentarianism"]:
        assert count(x) == want(x)
    assert count(None) == 0


def test_deep_shallow_order_and_prefixes():
    r = random.Random(4)
    for _ in range(60):
        base = bytes(r.choice(b"ab\0") for _ in range(90))
        strings = [base[: r.randint(0, 90)] + bytes(r.choice(b"ab\0") for _ in range(r.randint(0, 12))) for _ in range(r.randint(1, 40))]
        order, common = suffix_sort.deep_shallow(strings, 100)
        assert sorted(order) == list(range(len(strings)))
        keys = [(strings[i].ljust(104, b"\0"), len(strings[i])) for i in order]
        assert keys == sorted(keys)
        for a, b, c in zip(order, order[1:], common[1:], strict=False):
            x, y = strings[a], strings[b]
            want = next((k for k in range(min(len(x), len(y))) if x[k] != y[k]), min(len(x), len(y)))
            assert c == want


def test_anchors_depend_on_content_only():
    r = random.Random(5)
    text = bytes(r.choice(b"abcdefgh ") for _ in range(3000))
    at = {}
    for raw in (text, b"zz" * 50 + text):
        shift = len(raw) - len(text)
        h, pos, first, last = substring_dedup.anchors(raw)
        assert first[0] == 0 and last[-1] == len(raw) - 400 and (first[1:] == last[:-1] + 1).all()
        at[shift] = {s - shift: (hh, p - shift) for hh, p, f, e in zip(h, pos, first, last, strict=True) for s in range(f, e + 1)}
    assert all(at[100][s] == at[0][s] for s in at[0])
    assert len(substring_dedup.anchors(b"x" * 399)[0]) == 0


def test_fingerprint_edges():
    import xxhash

    assert simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0
    assert simhash.fingerprint("A b") == xxhash.xxh64_intdigest(b"a b", 42)
    assert simhash.fingerprint("É B") == xxhash.xxh64_intdigest("É b".encode(), 42)


def test_threshold_allocation_covers_the_radius():
    r = np.random.default_rng(6)
    x = (r.random((500, 64)) < 0.5).astype(float)
    for radius, most in ((4, None), (8, 4)):
        probes = simhash.plan(500, x.T @ x, radius, most)
        for _ in range(300):
            flips = r.choice(64, size=r.integers(0, radius + 1), replace=False)
            d = sum(1 << int(b) for b in flips)
            assert any((d & mask) in set(keys) for mask, keys in probes)


@pytest.mark.parametrize(("bits", "broadcast"), [(dc.MOST_BITS, dc.BROADCAST_ROWS), (7, 0)])
def test_containment_is_exact(spark, monkeypatch, bits, broadcast):
    """Whatever the bit set lets pass and however rows meet, the pairs are those of all shingles."""
    monkeypatch.setattr(dc, "MOST_BITS", bits)
    monkeypatch.setattr(dc, "BROADCAST_SKETCHES", broadcast)
    monkeypatch.setattr(dc, "BROADCAST_ROWS", broadcast)
    r = random.Random(7)
    word = lambda: r.choice("alpha beta gamma delta eps zeta eta theta iota kappa".split()) + str(r.randint(0, 9))
    items = [(i, " ".join(word() for _ in range(r.randint(0, 30)))) for i in range(60)] + [(99, None), (99, ""), (7, "one two")]
    docs = [None, "", "one two", "One, TWO!", *[" ".join(word() for _ in range(r.randint(0, 200))) + " " + items[r.randrange(60)][1][: r.randint(0, 200)].upper() for _ in range(80)]]
    docs += docs[10:12]
    want = []
    for k, d in enumerate(docs):
        have = set(dc.shingles(dc.normal(d)))
        for i, t in items:
            s = set(dc.shingles(dc.normal(t)))
            if s and len(s & have) >= np.ceil(0.8 * len(s) - 1e-9):
                want.append((k, i, len(s & have), len(s)))
    table = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string").repartition(2)
    assert sorted(tuple(x) for x in dc.contained_items(table, bench).collect()) == sorted(want) and len(want) > 20
    assert {x["doc_id"] for x in dc.drop_contaminated(table, bench).collect()} == set(range(len(docs))) - {w[0] for w in want}


def test_forward_backward_is_exact():
    r = np.random.default_rng(8)
    lengths, trans = np.array([4, 3, 1]), r.normal(size=(3, 3))
    per = [r.normal(size=(n, 3)) for n in lengths]
    packed = np.array([per[k][t] for t in range(4) for k in range(3) if t < lengths[k]])
    g = li._chain(packed, lengths, trans)[0]
    rows = [(t, k) for t in range(4) for k in range(3) if t < lengths[k]]
    for k, n in enumerate(lengths):
        want = np.zeros((n, 3))
        for path in np.ndindex(*[3] * n):
            w = np.exp(sum(per[k][t][path[t]] for t in range(n)) + sum(trans[a, b] for a, b in zip(path, path[1:], strict=False)))
            for t in range(n):
                want[t, path[t]] += w
        want /= want.sum(axis=1, keepdims=True)
        assert np.allclose([g[rows.index((t, k))] for t in range(n)], want)


def test_mixed_sentences_are_labelled_by_word():
    r = random.Random(9)
    vocab = {"aa": ["tion", "the", "ing", "and"], "bb": ["schaft", "und", "der", "keit"]}
    make = lambda lang, n: ["".join(r.choice(vocab[lang]) for _ in range(r.randint(1, 3))) for _ in range(n)]
    tagger = li.WordTagger.fit([(lang, make(lang, 60)) for lang in vocab for _ in range(20)], epochs=25)
    good = total = 0
    for _ in range(30):
        words = make("aa", 8) + make("bb", 8)
        got = tagger.marginals([words])[0].argmax(axis=1)
        good += sum(tagger.labels[g] == ("aa" if i < 8 else "bb") for i, g in enumerate(got))
        total += 16
    assert good / total > 0.95


def test_pages_keep_order_positions_and_captions():
    page = '<html><head><title>x</title></head><body><p>One <b>two</b></p><img src="sha256:00" alt="first"><script>var a="<p>";</script><figure><img src="u"><figcaption>A &amp; B</figcaption></figure>tail</body></html>'
    got = [(e["pos"], e["kind"], e["text"], e["ref"], e["caption"]) for e in media.parse_page(page)]
    assert got == [(0, "text", "One two", None, None), (1, "media", None, "sha256:00", "first"), (2, "media", None, "u", "A & B"), (3, "text", "tail", None, None)]
    assert media.parse_page(None) == media.parse_page("") == []
    for raw in (b"", b"x" * 64, b"x" * 65):
        assert media.from_media(media.to_media(media.pad(raw))) == media.pad(raw) and len(media.pad(raw)) % 64 == 0 and media.pad(raw)


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<html><head><meta charset=utf-8><title>x</title><body><p>seen", [("text", "seen")]),
        ("<head><title>x<body><p>seen</p>", [("text", "seen")]),
        ('<p>a</p><script src="x"/><p>b</p>', [("text", "a"), ("text", "b")]),
        ('<figure><figcaption>before</figcaption><img src="u" alt="alt"></figure>tail', [("media", "before"), ("text", "tail")]),
        ("<figure><figcaption>no media</figcaption></figure><p>b", [("text", "no media"), ("text", "b")]),
        ('<figure><img src="u"><figcaption>cap<p>rest</p><p>of the page</p>', [("media", "cap"), ("text", "rest"), ("text", "of the page")]),
        ('<figure><img src="u"><figcaption>open</figure><p>after', [("media", "open"), ("text", "after")]),
        ('<figure><img src="a"><figure><img src="b"><figcaption>in</figcaption></figure><figcaption>out</figcaption></figure>', [("media", "out"), ("media", "in")]),
        ('<figure><figure><img src="b"></figure><figcaption>out</figcaption></figure>', [("media", "out")]),
        ('<img src="u" data-bytes="\u00b2" title="t"><noscript>n</noscript>c', [("media", "t"), ("text", "c")]),
        ("<figcaption>alone</figcaption> text", [("text", "alone"), ("text", "text")]),
    ],
)
def test_pages_lose_no_text_and_no_caption(page, want):
    got = media.parse_page(page)
    assert [(e["kind"], e["caption"] if e["kind"] == "media" else e["text"]) for e in got] == want
    assert [e["pos"] for e in got] == list(range(len(got)))


def test_whole_words_of_any_length_are_features():
    from linkwright.llm import language_id

    words = ["a", "x" * 40 + "q" + "y" * 40, "z" * 300_000]
    row, index = language_id.features(words)
    assert np.bincount(row).tolist() == [2 + 1 + 2 + 1, 82 + 81 + 8 + 1, 300_001 + 300_000 + 8 + 1]
    alone = [sorted(language_id.features([w])[1].tolist()) for w in words]
    assert [sorted(index[row == k].tolist()) for k in range(3)] == alone
    changed = language_id.features(["x" * 40 + "r" + "y" * 40])[1]
    assert sorted(changed.tolist()) != alone[1]
