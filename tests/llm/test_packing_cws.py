import hashlib
import random

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from helpers import AWKWARD, EXTRA, PROSE, documents
from tokenizers import Tokenizer

from blendwise.llm import cws, packing


def brute_pack(lengths, capacity):
    """Best fit decreasing by looking at every window; of equally tight ones the last opened or changed."""
    rooms, where, offsets, stamp = [], [0] * len(lengths), [0] * len(lengths), []
    for t, i in enumerate(sorted(range(len(lengths)), key=lambda i: -lengths[i])):
        fits = [(room, -stamp[w], w) for w, room in enumerate(rooms) if room >= lengths[i]]
        if fits:
            w = min(fits)[2]
        else:
            w = len(rooms)
            rooms.append(capacity)
            stamp.append(0)
        where[i], offsets[i] = w, capacity - rooms[w]
        rooms[w] -= lengths[i]
        stamp[w] = t
    return where, offsets


@pytest.mark.parametrize("capacity", [1, 7, 64, 100])
def test_tree_finds_the_tightest_window(capacity):
    rng = random.Random(capacity)
    for _ in range(60):
        lengths = [rng.randint(0, capacity) for _ in range(rng.randint(0, 80))]
        assert packing.best_fit_decreasing(lengths, capacity) == brute_pack(lengths, capacity)


def test_pieces_and_sequences(spark):
    path = P.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    docs = documents(spark, AWKWARD + [(40, "it's <|endoftext|> NAÏVE é x  y")], **EXTRA)
    pieces = packing.tokenised_pieces(docs, path)
    out = packing.pack(pieces, group_pieces=6).collect()
    texts = {}
    for r in sorted(out, key=lambda r: (r.row_id, r.start)):
        texts.setdefault(r.row_id, [r.doc_id, []])[1] += np.frombuffer(r.ids, "<u4").tolist()
        assert 0 < r.length <= packing.WINDOW and r.start % packing.WINDOW == 0
    rows = docs.select("doc_id", "text").collect()
    want = [(r.doc_id, library.encode(r.text or "", add_special_tokens=False).ids + [2]) for r in rows]
    assert sorted(texts.values(), key=str) == sorted(map(list, want), key=str)
    assert all(r.doc_tokens == len(texts[r.row_id][1]) for r in out)
    windows = {}
    for r in out:
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in windows.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= packing.WINDOW
    assert packing.pack(packing.tokenised_pieces(docs.limit(0), path)).count() == 0


def test_plain_runs_skip_the_normaliser_and_line_ends_split_words():
    class Seen:
        def __init__(self, inner):
            self.inner, self.model, self.texts = inner, inner.model, []

        def encode(self, text, **how):
            self.texts.append(text)
            return self.inner.encode(text, **how)

    path = P.path("word_bpe_49k.json")
    words = packing.WordTokenizer(path)
    words.tokenizer = seen = Seen(words.tokenizer)
    text = "Plain words here.\nOther words, naïve ones\nend"
    (ids,) = words.encode(pa.array([text]))
    assert ids.tolist() == seen.inner.encode(text, add_special_tokens=False).ids
    assert not set("plain words here other ones end".split()) & set(" ".join(seen.texts).lower().split())
    assert "naïve" in " ".join(seen.texts) and not any("\n" in w for w in words.known)


def jaccard(a, b):
    a, b = cws.term_weights(a), cws.term_weights(b)
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def test_collision_rate_is_the_generalised_jaccard_similarity():
    sampler, rng = cws.Sampler(samples=2048), random.Random(1)
    words = [f"w{i}" for i in range(40)]
    for _ in range(12):
        a = " ".join(rng.choices(words, k=rng.randint(5, 300)))
        b = cws.edited(a, " ".join(rng.choices(words, k=200))) + " " + a[:rng.randint(0, 300)]
        x, y = sampler.fingerprints([a, b])
        assert abs(cws.likeness(x, y) - jaccard(a, b)) < 0.05


def test_blocks_and_forgetting_do_not_change_a_fingerprint(monkeypatch):
    texts = [PROSE, "x " * 50, " ".join(f"t{i % 700}" for i in range(3000))]
    want = [cws.as_hex(v) for v in cws.Sampler().fingerprints(texts)]
    monkeypatch.setattr(cws, "BLOCK", 16)
    small = cws.Sampler(kept=3)
    assert [cws.as_hex(small.fingerprints([t])[0]) for t in texts] == want


def test_draws_fit_a_cache_and_each_pair_is_looked_up_once(monkeypatch):
    sizes, drawn = [], cws.draw
    monkeypatch.setattr(cws, "draw", lambda t, w, n: (sizes.append(len(t)), drawn(t, w, n))[1])
    sampler = cws.Sampler()
    text = " ".join(f"t{i % 900}" for i in range(1000))
    (found,) = sampler.fingerprints([text])
    terms = list(cws.term_weights(text).items())
    ln_a, value = drawn(np.array([cws.xxhash.xxh64_intdigest(w.encode()) for w, _ in terms], np.uint64), np.array([n for _, n in terms]))
    assert (found == value[ln_a.argmin(0), np.arange(cws.SAMPLES)]).all()
    assert sum(sizes) == 900 and max(sizes) <= 256
    assert set(sampler.rows) == {w if n == 1 else (w, n) for w, n in terms}


@pytest.mark.parametrize("range_bytes", [16 << 20, 2000])
def test_edited_texts_and_neighbours(spark, range_bytes):
    rows = AWKWARD + [(100 + i, f"{PROSE[:30 * i]} number {i}") for i in range(30)]
    docs = documents(spark, rows, **EXTRA)
    got = sorted(map(tuple, cws.with_neighbours(docs, cws._fingerprint_range, cws.SCHEMA, range_bytes=range_bytes).collect()), key=str)
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    sampler, want = cws.Sampler(), []
    prints = sampler.fingerprints([t or "" for _, t in order])
    for n, (i, text) in enumerate(order):
        nxt = (n + 1) % len(order)
        text, following = text or "", order[nxt][1] or ""
        k = len(text) // 4
        changed = text[:len(text) - k] + following[:k]
        e = sampler.fingerprints([changed])[0]
        want.append((i, len(text), hashlib.sha256(changed.encode()).hexdigest(), cws.as_hex(prints[n]), cws.as_hex(e),
                     cws.likeness(prints[n], e), cws.likeness(prints[n], prints[nxt])))
    assert got == sorted(want, key=str)


def test_few_documents(spark):
    for rows in ([], [(1, "one two")], [(None, "a"), (None, "b")]):
        out = cws.weighted_fingerprints(documents(spark, rows)).collect()
        assert len(out) == len(rows)
    assert cws.weighted_fingerprints(documents(spark, [(1, "one two")])).first().near_next == 1.0


def test_words_in_one_call_have_the_ids_of_the_text():
    import random

    import pyarrow as pa
    import public_tokenizers
    from tokenizers import Tokenizer

    from blendwise.llm import packing
    path = P.path("word_bpe_49k.json")
    rng, plain, own = random.Random(1), Tokenizer.from_file(path), packing.WordTokenizer(path)
    signs = "abcXYZéßñ日本語012!?.,'\"$%&#\x01\x02\t\ń 　\U0001F600ā<>[]() "
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 60))) for _ in range(3000)] + [None, "", " ", "\x01", "it's 1\x01 a\x01b"]
    for text, ids in zip(texts, own.encode(pa.array(texts, pa.string()))):
        assert ids.tolist() == plain.encode(text or "", add_special_tokens=False).ids, repr(text)


def test_words_settled_at_once_and_later_have_the_tokenizers_ids():
    """Runs and signs are new in the first call and known in the second, in which words are settled as they are read."""
    path = P.path("word_bpe_49k.json")
    words, plain = packing.WordTokenizer(path), Tokenizer.from_file(path)
    for text in ("River river, RIVER! Fluß fluß; Été naïve. ... x1 日本, a\x01b", "RIVER, rIver!! Fluß! Fluß, été; Naïve?! !!! river日本 naïve.x X1,"):
        (found,) = words.encode(pa.array([text]))
        assert found.tolist() == plain.encode(text, add_special_tokens=False).ids
