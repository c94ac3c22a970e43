"""The parts that run inside tasks, against plain Python."""

import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

import public_tokenizers
from moniker.llm import jaccard, lattice, maxent, nearest, pieces, words

TEXTS = ["", None, " ", "a", "Ab  c\td\n", "é ß 𝔘 x", "\x0b\x0c\r", "one two three four five", "x" * 300, "a b" * 400]
WORD_CHARACTERS = st.text(st.sampled_from("ab AB\té▁ \n<>0x"), max_size=80)


def plain_words(text):
    lowered = (text or "").translate({i: i + 32 for i in range(65, 91)})
    for c in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(c, " ")
    return [w for w in lowered.split(" ") if w]


def parity_twins(size):
    """Two words of ``size`` letters by the parity of the bits of the place, one the other's exchange."""
    odd = [bin(i).count("1") & 1 for i in range(size)]
    return ["".join("ab"[x ^ y] for x in odd) for y in (0, 1)]


def test_structured_words_have_different_hashes():
    made = [w for n in (8, 64, 1024, 2048) for w in parity_twins(n)]
    made += ["a" * i + "b" + "a" * (99 - i) for i in range(100)] + [x * 8 + y * 8 for x in "abcd" for y in "abcd"] + ["\0" * i + "x" for i in range(40)]
    assert len(set(words.hashed_words(pa.array(made))[0].tolist())) == len(set(made))


def test_hashes_do_not_depend_on_the_place():
    draw = random.Random(3)
    own = ["".join(draw.choice("abé𝔘") for _ in range(n)) for n in (1, 7, 8, 9, 16, 17, 4000)]
    alone = [words.hashed_words(pa.array([w]))[0][0] for w in own]
    for shift in range(9):
        assert words.hashed_words(pa.array(["x" * shift + " " + " ".join(own)]))[0][-len(own) :].tolist() == alone


@pytest.mark.parametrize("block", [8, 1 << 17])
def test_words_and_hashes(monkeypatch, block):
    monkeypatch.setattr(words, "BLOCK", block)
    hashes, first = words.hashed_words(pa.array(TEXTS))
    got = [hashes[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)]
    want = [plain_words(t) for t in TEXTS]
    assert list(map(len, got)) == list(map(len, want))
    pairs = {(h, w) for hs, ws in zip(got, want, strict=True) for h, w in zip(hs, ws, strict=True)}
    assert len(pairs) == len({h for h, _ in pairs}) == len({w for _, w in pairs})


def test_sliced_and_empty_columns():
    column = pa.array(["x"] + TEXTS)[1:]
    assert words.hashed_words(column)[0].tolist() == words.hashed_words(pa.array(TEXTS))[0].tolist()
    assert len(words.hashed_words(pa.array([], pa.string()))[0]) == 0
    assert list(words.row_chunks(pa.array([], pa.string()))) == []


def test_row_chunks_cover_all_rows():
    column = pa.array(["a" * n for n in (5, 0, 20, 3, 3, 3, 0)])
    chunks = list(words.row_chunks(column, 7))
    assert [r for a, b in chunks for r in range(a, b)] == list(range(7))


def test_groups_join_batches():
    batches = [pa.RecordBatch.from_pydict({"k": k}) for k in ([1, 1, 2], [], [2, 2], [3])]
    batches[1] = batches[0].slice(0, 0)
    assert [t.column("k").to_pylist() for t in words.groups(iter(batches), ["k"])] == [[1, 1], [2, 2, 2], [3]]


@pytest.fixture(scope="module")
def model():
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as file:
        return file.read()


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def encoder(model):
    return pieces.Encoder(model)


def encoded(encoder, column):
    flat, first = encoder.units(column).flat_ids(encoder.model.end)
    return [flat[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)]


@settings(max_examples=60, deadline=None)
@given(texts=st.lists(st.one_of(st.none(), WORD_CHARACTERS, st.text(max_size=30)), min_size=1, max_size=8))
def test_pieces_equal_the_library(encoder, library, texts):
    got = encoded(encoder, pa.array(texts, pa.string()))
    assert got == library.encode([t or "" for t in texts], add_eos=True)
    assert [encoder.model.decode(ids) for ids in got] == library.decode(got)


def test_long_units_and_unknown_characters(encoder, library):
    texts = ["ab" * 400, " " * 500 + "x", "日本" * 200, "𝔘" * 150, "a" * 97, "the" * 32, "\0é\0"]
    assert encoded(encoder, pa.array(texts)) == library.encode(texts, add_eos=True)


def test_words_with_structured_bytes(encoder, library):
    texts = [" ".join(parity_twins(n)) for n in (1024, 2048)] + parity_twins(1024)
    assert encoded(encoder, pa.array(texts)) == library.encode(texts, add_eos=True)


def test_units_with_one_hash(encoder, library, monkeypatch):
    monkeypatch.setattr(pieces, "hash_ranges", lambda data, starts, ends: (ends - starts).astype(np.uint64))
    texts = ["one two six ten", "the fox ran off", "ten one", ""]
    assert encoded(encoder, pa.array(texts)) == library.encode(texts, add_eos=True)


@pytest.mark.parametrize("long", [4, 4096])
def test_merges_at_once_and_by_heap_equal_the_library(encoder, library, monkeypatch, long):
    monkeypatch.setattr(pieces, "LONG", long)
    draw = random.Random(7)
    texts = ["".join(draw.choice(a) for _ in range(draw.randrange(300))) for a in ("ab", "aeinrst", "abcdefghijklmnopqrstuvwxyz", "a", "01", "=-", "日本語のは", "éèàß") for _ in range(20)]
    assert encoded(encoder, pa.array(texts)) == library.encode(texts, add_eos=True)


def test_decoding_any_ids(encoder, library):
    draw = random.Random(4)
    for _ in range(500):
        ids = [draw.choice([draw.randrange(32000), draw.randrange(3, 259), 259, 28705, 0, 1, 2]) for _ in range(draw.randrange(12))]
        assert encoder.model.decode(ids) == library.decode(ids), ids


def shingle_set(text):
    own = plain_words(text)
    return {tuple(own[i : i + 4]) for i in range(len(own) - 3)} if len(own) >= 4 else {tuple(own)} if own else set()


def near_texts(seed, count=60):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(500)]
    out = []
    for _ in range(count):
        base = [draw.choice(vocabulary) for _ in range(draw.choice([1, 2, 3, 4, 5, 7, 9, 12, 16, 24, 40, 90, 300]))]
        for _ in range(4):
            own = list(base)
            for _ in range(draw.randrange(0, 2 + len(own) // 40)):
                at = draw.randrange(len(own))
                own[at : at + draw.choice([0, 1])] = draw.choice([[draw.choice(vocabulary)], []])
                own = own or ["w0"]
            out.append(" ".join(own))
    return out


@pytest.mark.parametrize("leave_out", [False, True])
@pytest.mark.parametrize("seed", range(4))
def test_linked_sets_share_a_signature(seed, leave_out):
    texts, rule = near_texts(seed), jaccard.Rule()
    shingles, begins = jaccard.shingle_sets(pa.array(texts), rule)
    sets = [shingle_set(t) for t in texts]
    assert np.diff(begins).tolist() == list(map(len, sets))
    shown, first = jaccard.signatures(shingles, begins, rule, jaccard.ways_of(rule, leave_out))
    own = [set(shown[a:b].tolist()) for a, b in zip(first[:-1], first[1:], strict=True)]
    bits = [np.frombuffer(jaccard.parities(shingles[a:b]), np.uint64) for a, b in zip(begins[:-1], begins[1:], strict=True)]
    links = 0
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a != b and a and b and 100 * len(a & b) >= 85 * len(a | b):
                links += 1
                assert own[i] & own[j]
                assert jaccard._near(rule, [bits[i]], [bits[j]], np.array([len(a)]), np.array([len(b)])).all()
    assert links > 10


@pytest.mark.parametrize("rule", [jaccard.Rule(), jaccard.Rule(words=5, least=80)])
def test_plain_segments_show_fewer_signatures_than_shingles(rule):
    for n in (8, 20, 100, 500, 3000):
        shingles = words.mix(np.arange(n, dtype=np.uint64))
        shown, _ = jaccard.signatures(shingles, np.array([0, n]), rule, jaccard.ways_of(rule))
        assert len(shown) <= 0.6 * n + 2


def test_spanning_forest_joins_what_the_edges_join():
    draw = np.random.default_rng(0)
    for _ in range(50):
        n = 30
        x, y = draw.integers(0, n, (2, 40))
        part = draw.integers(0, 20, n)
        kept = jaccard._spanning(x, y, part)

        def reach(edges, part=part, x=x, y=y):
            label = part.copy()
            for _ in range(n):
                for e in edges:
                    low, high = sorted((label[x[e]], label[y[e]]))
                    label[label == high] = low
            return label.tolist()

        assert reach(range(40)) == reach(kept) and len(kept) < 20


def test_lattice_points_are_the_nearest():
    draw = np.random.default_rng(1)
    points = draw.normal(size=(200, 8)) * 2
    found = lattice.decode_e8(points)
    assert ((found % 2 == 0).all(axis=1) | (found % 2 != 0).all(axis=1)).all() and (found.sum(axis=1) % 4 == 0).all()
    far = ((2 * points - found) ** 2).sum(axis=1)
    for v in lattice.shortest_vectors():
        assert (far <= ((2 * points - found - v) ** 2).sum(axis=1) + 1e-9).all()
    assert len(np.unique(lattice.shortest_vectors(), axis=0)) == 240


def test_chi_square_quantiles():
    assert nearest.chi_square_quantile(0.95, 8) == pytest.approx(15.507, abs=1e-3)
    assert nearest.chi_square_quantile(0.5, 2) == pytest.approx(1.386, abs=1e-3)


def test_model_probabilities_sum_to_one():
    prior = np.arange(maxent.CLASSES * maxent.LEAVES) + 1.0
    model = maxent.Model(prior)
    trainer, draw = maxent.Trainer(model), np.random.default_rng(2)
    leaf = draw.integers(0, len(prior), 500)
    before, ahead = np.roll(leaf, 1), np.roll(leaf, 2)
    start = model.logs(before, ahead, leaf).sum()
    for _ in range(20):
        trainer.learn(before, ahead, leaf)
    assert model.logs(before, ahead, leaf).sum() > start
    every = np.arange(len(prior))
    same = np.full(len(prior), 7)
    assert (10 ** model.logs(same, same, every)).sum() == pytest.approx(1, abs=1e-4)


def test_digest_of_an_empty_text(encoder):
    ids, first = encoder.units(pa.array(["", None])).flat_ids(encoder.model.end)
    assert list(pieces._digests(encoder.model.numbers, ids, first)) == [hashlib.sha256(b"2").hexdigest()] * 2
    assert list(pieces._digests(encoder.model.texts, ids, first)) == [hashlib.sha256(b"").hexdigest()] * 2


def test_summed_is_reduceat():
    """Slots with few and with many rows get the very sums of ``reduceat``; temporaries of a softmax stay small."""
    draw = np.random.default_rng(5)
    slot = np.concatenate([np.repeat(np.arange(200), np.arange(200) % 23 + 1), np.full(3000, 777)])
    draw.shuffle(slot)
    gradient = draw.normal(size=(len(slot), maxent.CLASSES)).astype(np.float32)
    order = np.argsort(slot, kind="stable")
    starts = np.searchsorted(slot[order], np.unique(slot))
    found, sums = maxent._summed(slot, gradient)
    assert found.tolist() == np.unique(slot).tolist()
    assert sums.tobytes() == np.add.reduceat(gradient[order], starts, axis=0).tobytes()

    weights, bias = draw.normal(size=(64, maxent.CLASSES)).astype(np.float32), np.ones(maxent.CLASSES, np.float32)
    first, second = draw.integers(0, 64, (2, maxent.BATCH))
    tracemalloc.start()
    told = maxent._softmax(weights, first, second, bias)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    plain = np.exp((x := weights[first] + weights[second] + bias) - x.max(axis=1, keepdims=True))
    assert told.tobytes() == (plain / plain.sum(axis=1, keepdims=True)).tobytes()
    assert most < 1.5 * told.nbytes
