"""The corpus operators against brute force on small tables with awkward rows."""

import hashlib
import itertools
import math
import random
import re
import struct
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from voltaweave.llm import chat, decontam, exact_dedup, minhash_dedup, neardup, packing, quality, sketch, substring_dedup, suffix_dedup, toxicity, url_filter

SCHEMA = "doc_id long, text string, n string, key string, row string, gone_id long, fp long"
RNG = random.Random(3)
WORDS = ["".join(RNG.choice("abcdefgh") for _ in range(RNG.randint(2, 7))) for _ in range(400)]


def words(n):
    return " ".join(RNG.choice(WORDS) for _ in range(n))


BASE, SHARED, ITEM = words(60), words(40), words(25)


def edited(text, k):
    w = text.split()
    for i in RNG.sample(range(len(w)), k):
        w[i] = w[i] + "x"
    return " ".join(w)


TEXTS = [
    None, "", "   ", "one", "One two three", BASE, BASE, BASE.upper(), edited(BASE, 1), edited(BASE, 2), edited(BASE, 3), edited(BASE, 1),
    SHARED + "\n" + words(30), words(20) + "\n" + SHARED, words(15) + "\n" + SHARED + "\n" + words(15), words(3000), "ab " * 200, "ñandú É é " * 40,
    ITEM, words(10) + " " + " ".join(ITEM.split()[5:18]).upper() + ", " + words(10), ITEM[: len(ITEM) // 2], "x" * 350, "x" * 90, words(6), words(6),
]


def rows(texts=TEXTS):
    return [(i, t, "a", "b", "c", 1, 2) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids, repeated rows and one id on two texts."""
    made = rows() + [(None, BASE, "", "", "", 1, 2), (None, None, "", "", "", 1, 2), (5, BASE, "a", "b", "c", 1, 2), (3, BASE, "", "", "", 0, 0)]
    return spark.createDataFrame(made, SCHEMA)


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# ---- 6


def test_exact_classes(docs):
    groups = defaultdict(list)
    for i, t, *_ in rows():
        groups[t or ""].append(i)
    want = {i: (max(g), len(g), i == max(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g}
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_dedup.classify(docs).collect()}
    assert got == want


def test_exact_stage(docs, odd, empty):
    assert {r.doc_id for r in exact_dedup.deduplicate(docs).collect()} == set(range(len(TEXTS))) - {0, 5}
    assert exact_dedup.deduplicate(docs).columns == docs.columns
    got = sorted((r.doc_id for r in exact_dedup.deduplicate(odd).collect()), key=str)
    assert len(got) == len({t or "" for t in TEXTS}) and None not in got
    assert exact_dedup.classify(odd).count() == len(TEXTS) + 4
    assert exact_dedup.classify(empty).count() == exact_dedup.deduplicate(empty).count() == 0


@settings(max_examples=30, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 40), max_size=60), min_size=1, max_size=4), st.integers(3, 9))
def test_quotient_filters_merge_without_loss(parts, bits):
    blocks = defaultdict(list)
    for p in parts:
        for block, *blobs in exact_dedup.filter_blocks(np.array(p, np.uint64), bits):
            blocks[block].append(blobs)
    got = {}
    for block, blobs in blocks.items():
        values, counts = exact_dedup.merge_blocks(block, blobs, bits)
        got.update(zip(values.tolist(), counts.tolist(), strict=True))
    want = defaultdict(int)
    for p in parts:
        for v in p:
            want[v] += 1
    assert got == dict(want)


def test_a_filter_is_as_large_as_what_it_holds():
    fps = np.random.default_rng(1).integers(0, 2**64, 100_000, dtype=np.uint64)
    made = list(exact_dedup.filter_blocks(fps, 15))
    assert len(made) > 30_000 and sum(map(len, (x for row in made for x in row[1:]))) < 1.5 * 16 * len(fps)


# ---- 4


def test_packing_covers_each_id_once(docs, empty):
    tokenizers = pytest.importorskip("tokenizers")
    path = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
    whole = tokenizers.Tokenizer.from_file(path)
    ids = {i: [*whole.encode(t or "", add_special_tokens=False).ids, 2] for i, t, *_ in rows()}
    seen = defaultdict(list)
    sequences = set()
    for r in packing.pack(docs, path, 2, longest=512).collect():
        assert r.length & (r.length - 1) == 0 and r.length <= 512 and r.offset == 0 and r.doc_tokens == len(ids[r.doc_id])
        assert struct.unpack(f"<{r.length}I", r.ids) == tuple(ids[r.doc_id][r.start : r.start + r.length])
        seen[r.doc_id] += range(r.start, r.start + r.length)
        sequences.add(r.sequence_id)
    assert all(sorted(seen[i]) == list(range(len(ids[i]))) for i in ids)
    assert packing.pack(empty, path, 2).count() == 0


def test_buckets_hold_one_length(spark, docs, odd, tmp_path):
    path = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
    pieces = packing.pack(docs, path, 2, longest=512)
    packing.write_buckets(pieces, f"{tmp_path}/buckets")
    for r in spark.read.parquet(f"{tmp_path}/buckets").groupBy("bucket").agg({"length": "min", "*": "count"}).collect():
        assert r["min(length)"] == 2 ** r.bucket
    for b in {r.bucket for r in pieces.collect()}:
        assert {r.length for r in spark.read.parquet(f"{tmp_path}/buckets/bucket={b}").collect()} == {2**b}
    # null and repeated ids: each row is packed on its own
    told = packing.pack(odd, path, 2).collect()
    assert sum(r.length for r in told if r.doc_id is None and r.doc_tokens == 1) == 1
    assert len({r.sequence_id for r in told}) == len(told) and sum(r.start == 0 for r in told) == len(TEXTS) + 4


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abcABC ñÉÑß.,'!?$%0<>|9\n\t\x1c\u0301ΣİÅ\u00a0", max_size=30) | st.sampled_from(["it's, don't", "<|endoftext|>.", "ABC... 'll"]), max_size=8))
def test_word_encoder_is_the_tokenizer(texts):
    tokenizers = pytest.importorskip("tokenizers")
    path = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
    whole = tokenizers.Tokenizer.from_file(path)
    encoder = packing.WordEncoder(path, most=20)
    for _ in range(2):
        for text, data in zip(texts, encoder.encode(texts), strict=True):
            assert list(struct.unpack(f"<{len(data) // 4}I", data)) == whole.encode(text, add_special_tokens=False).ids


def test_piece_lengths():
    for n in range(1, 300):
        pieces = packing.piece_lengths(n, 64)
        assert sum(pieces) == n and pieces == sorted(pieces, reverse=True) and len(set(p for p in pieces if p < 64)) == len([p for p in pieces if p < 64])


# ---- 5


def test_decontamination(spark, docs, odd, empty):
    bench = spark.createDataFrame([(7, ITEM), (12, ITEM.upper()), (3, "one"), (4, ""), (5, None), (6, "two THREE")], "item_id long, text string")
    find = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall
    windows = defaultdict(set)
    for i, t in [(r.item_id, r.text) for r in bench.collect()]:
        w = find(lowered(t))
        for k in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[k : k + 10])].add(i)

    def truth(text):
        w, hit, items = find(lowered(text)), set(), set()
        for win, ids in windows.items():
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k : k + len(win)]) == win:
                    hit.update(range(k, k + len(win)))
                    items |= ids
        names = ",".join(sorted(map(str, items)))
        return len(w), len(hit), len(items), hashlib.sha256(names.encode()).hexdigest(), bool(hit)

    def told(df):
        return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontam.classify(df, bench).collect()), key=str)

    assert told(docs) == sorted(((i, *truth(t)) for i, t, *_ in rows()), key=str)
    assert told(odd) == sorted(((r.doc_id, *truth(r.text)) for r in odd.collect()), key=str)
    assert told(empty) == []
    assert decontam.classify(docs, bench.limit(0)).filter("contaminated").count() == 0
    assert {r.doc_id for r in decontam.clean(docs, bench).collect()} == {i for i, t, *_ in rows() if not truth(t)[4]}


def test_stages_decide_by_row(spark, labelled):
    bench = spark.createDataFrame([(7, ITEM)], "item_id long, text string")
    made = [(None, ITEM), (None, BASE), (1, ITEM), (1, BASE), (1, BASE), (2, None)]
    df = spark.createDataFrame(made, "doc_id long, text string")
    got = sorted((tuple(r) for r in decontam.clean(df, bench).collect()), key=str)
    assert got == sorted([(None, BASE), (1, BASE), (1, BASE), (2, None)], key=str)
    docs, labels = labelled
    good, junk = words(60), words(60).upper().replace(" ", "!! ")
    df = docs.unionByName(spark.createDataFrame([(5000, good), (5000, junk)], "doc_id long, text string"))
    assert [r.text for r in quality.select(df, labels).filter("doc_id = 5000").collect()] == [good]


# ---- 7 and 9


def components(sets, percent=75):
    names = sorted(sets)
    root = {i: i for i in names}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in names:
        for b in names:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in names}


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def test_minhash_components(docs, odd, empty):
    sets = {i: shingles(t) for i, t, *_ in rows()}
    root = components(sets)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash_dedup.classify(docs).collect()}
    assert got == {i: (len(sets[i]), root[i], root[i] == i) for i in sets}
    assert {r.doc_id for r in minhash_dedup.deduplicate(docs).collect()} == {i for i in sets if root[i] == i}
    told = minhash_dedup.classify(odd).collect()
    assert len(told) == len(TEXTS) + 4 and all(r.component_id is None and r.kept for r in told if r.doc_id is None)
    assert {r.component_id for r in told if r.doc_id == 3} == {3}
    assert minhash_dedup.classify(empty).count() == 0


def test_near_duplicates_go_by_row(spark, odd, empty):
    """Of one id only the texts that are near copies go; null ids take part."""
    near = edited(BASE, 1)
    other = words(80)
    made = [(0, BASE), (1, near), (1, other), (1, other), (None, other), (2, None), (2, ""), (3, None)]
    df = spark.createDataFrame([(*m, 1) for m in made], "doc_id long, text string, root long")
    got = minhash_dedup.deduplicate(df)
    assert got.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted([(0, BASE), (None, other), (2, None), (2, ""), (3, None)], key=str)
    left = minhash_dedup.deduplicate(odd).collect()
    # the null id comes first: no other text near its one stays
    assert [r.doc_id for r in left if shingles(r.text) and 100 * len(shingles(r.text) & shingles(BASE)) >= 75 * len(shingles(r.text) | shingles(BASE))] == [None]
    assert minhash_dedup.deduplicate(empty).count() == 0
    text_ids = spark.createDataFrame([("a", BASE), ("b", near), ("c", None)], "doc_id string, text string")
    assert sorted(r.doc_id for r in minhash_dedup.deduplicate(text_ids).collect()) == ["a", "c"]


@pytest.mark.parametrize("many", [1 << 16, 10])
def test_chains_of_near_copies(spark, monkeypatch, many):
    """A chain links what no star would; small blocks and joins agree with brute force."""
    monkeypatch.setattr(neardup, "MANY_PAIRS", many)
    monkeypatch.setattr(neardup, "BLOCK", 8)
    monkeypatch.setattr(neardup, "CHUNK", 3)
    text, made = words(120).split(), []
    for i in range(60):
        made.append((i, " ".join(text)))
        text[(i * 2) % 120] = f"step{i}"
    sets = {i: shingles(t) for i, t in made}
    df = spark.createDataFrame(made, "doc_id long, text string").repartition(4)
    assert {r.doc_id: r.component_id for r in minhash_dedup.classify(df).collect()} == components(sets)


def test_estimates_and_bands():
    a = [np.unique(np.random.default_rng(i).integers(0, 1 << 63, 300).astype(np.uint64)) for i in range(2)]
    b = np.unique(np.concatenate([a[0][:240], a[1][:60]]))
    perms = sketch.permutations(512)
    mins = sketch.minima([a[0], b], perms)
    true = len(np.intersect1d(a[0], b)) / len(np.union1d(a[0], b))
    assert abs((mins[0] == mins[1]).mean() - true) < 0.1
    bands, rows_ = sketch.tuned_bands(64, 0.75, 0.995)
    assert bands * rows_ <= 64 and 1 - (1 - 0.75**rows_) ** bands >= 0.995


def repeated_words(texts):
    """For each text, which words lie in 51 words that an earlier text has too."""
    first, out = {}, []
    for i, t in enumerate(texts):
        w = (t or "").encode().lower().split()
        hit = [False] * len(w)
        windows = [tuple(w[k : k + 51]) for k in range(len(w) - 50)]
        for k, x in enumerate(windows):
            if first.setdefault(x, i) != i:
                hit[k : k + 51] = [True] * 51
        out.append(hit)
    return out


def gone_words(r):
    hit = [False] * r.n_words
    for s, e in zip(r.starts, r.ends, strict=True):
        assert e - s >= 51
        hit[s:e] = [True] * (e - s)
    return hit


def test_passages(spark):
    """Equal passages wherever they lie: across lines, inside them, beside each other, in hot keys, at the limit of 51 words."""
    rng = random.Random(11)
    fill = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(7)) for _ in range(n))
    p, q, line, at_limit, short = fill(70), fill(60), fill(30), fill(51), fill(50)
    texts = [None, "", fill(300), f"{fill(20)} {p} {fill(10)}", f"{fill(9)}\n{q} {fill(30)}", f"{fill(3)} {p[: len(p) // 2]}\n{p[len(p) // 2 :]} {q}"]
    texts += [f"{fill(40)} {line} {fill(40)}" for _ in range(20)]
    tail = fill(30)  # of the texts that share a line only some share what follows it
    texts += [f"{fill(40)} {line} {tail} {fill(9)}" for _ in range(3)]
    texts += [f"{fill(5)} {at_limit} {fill(60)}", f"{fill(77)} {at_limit}", f"{fill(5)} {short} {fill(60)}", f"{fill(77)} {short}"]
    texts += [texts[2], texts[2], short, short, " ".join(["la"] * 90), f"{fill(60)} {' '.join(['la'] * 70)}", f"{p} {p}"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in substring_dedup.repeats(df).collect()}
    assert [i for i, h in enumerate(repeated_words(texts)) if h != gone_words(got[i])] == []
    for i, r in got.items():
        want = [w for w, g in zip((texts[i] or "").split(), gone_words(r), strict=True) if not g]
        assert r.kept_text.split() == want and (r.starts or r.kept_text == (texts[i] or ""))
    assert got[5].keep_ids == [3, 4] and got[33].keep_ids == [2] and got[33].kept_text == ""


def test_similar_passages(spark):
    rng = random.Random(12)
    fill = lambda n: ["".join(rng.choice("abcdefgh") for _ in range(7)) for _ in range(n)]
    made = []
    for _ in range(40):
        base = fill(120)
        other = [*base]
        other[40], other[80] = "replaced", "and more"  # one word for one, and two for one
        made += [" ".join([*fill(30), *base, *fill(30)]), " ".join([*fill(50), *other, *fill(10)])]
    df = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in substring_dedup.repeats(df).collect()}
    assert not any(got[i].starts for i in range(0, 80, 2))
    whole = [r for i, r in got.items() if i % 2 and r.starts == [50] and r.ends == [171] and r.keep_ids == [i - 1]]
    assert len(whole) >= 36


def test_passages_of_odd_rows(spark, odd, empty):
    told = substring_dedup.repeats(odd).collect()
    assert len(told) == len(TEXTS) + 4
    # the null id comes first and keeps the text; every equal one of 51 words or more goes whole
    assert all(bool(r.starts) == (r.doc_id is not None) for r in told if (r.text or "").lower() == BASE)
    assert {r.doc_id for r in told if r.starts and r.keep_ids == []} >= {3, 5, 6, 7}
    assert all(not r.starts and r.kept_text == r.text for r in told if r.n_words < 51)
    assert substring_dedup.repeats(empty).count() == 0


# ---- 10


def bytes_removed(texts, length):
    seen, out = set(), []
    for t in texts:
        data = (t or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            s = data[p : p + length]
            if s in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(s)
        out.append((len(data), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(bytes(x for x, g in zip(data, gone, strict=True) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize("piece", [500_000, 1000])
def test_repeated_bytes(docs, empty, piece):
    got = sorted(tuple(r) for r in suffix_dedup.digests(suffix_dedup.repeats(docs, piece=piece)).collect())
    assert got == [(i, *x) for i, x in enumerate(bytes_removed(TEXTS, 100))]
    assert suffix_dedup.digests(suffix_dedup.repeats(empty)).count() == 0


def test_repeated_bytes_with_odd_ids(odd):
    told = [tuple(r) for r in suffix_dedup.digests(suffix_dedup.repeats(odd)).collect()]
    assert len(told) == len(TEXTS) + 4
    n = len(BASE.encode())
    # the null id comes first and keeps the text; every other copy goes whole
    assert sorted(t[2] for t in told if t[1] == n and t[4] == hashlib.sha256(b"").hexdigest()) == [n] * 4
    assert (None, n, 0, 0, hashlib.sha256(BASE.encode()).hexdigest()) in told


def test_random_repeats(spark):
    rng = random.Random(9)
    blocks = ["".join(rng.choice("ab") for _ in range(rng.randint(10, 90))) for _ in range(12)]
    texts = ["".join(rng.choice(blocks) for _ in range(rng.randint(0, 8))) for _ in range(80)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    for length in (2, 20, 51, 100, 600):
        got = sorted(tuple(r) for r in suffix_dedup.digests(suffix_dedup.repeats(df, length)).collect())
        assert got == [(i, *x) for i, x in enumerate(bytes_removed(texts, length))]


# ---- 8


TEXT = st.text(alphabet="ab<>[]/\\sINTSYROLEgej= \n", max_size=20) | st.sampled_from(["</s>[INST] ok [/INST]", "\\", "<</SYS>>", "<<ROLE=x>>", "[/INST", "<"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", "", "<<x"]), TEXT), max_size=6))
def test_chat_reads_back(turns):
    formatted, spans = chat.format_turns(turns)
    assert chat.read_turns(formatted) == turns
    assert "".join(chat.unescape(formatted[a : a + n]) for a, n in spans) == "".join(t for r, t in turns if r == "assistant")


def test_reply_trees(spark):
    # tree 1: 0 -> 1 -> 3, 0 -> 2 -> 4 -> 5; tree 2: a ring and a lone root; tree 3: a long line
    made = [(1, 0, None, 0.0), (1, 1, 0, 5.0), (1, 2, 0, 1.0), (1, 3, 1, 1.0), (1, 4, 2, 1.0), (1, 5, 4, 1.0), (2, 0, 1, 0.0), (2, 1, 0, 0.0), (2, 7, 99, 0.0)]
    made += [(3, i, i - 1 if i else None, 0.0) for i in range(37)]
    nodes = spark.createDataFrame([(t, n, p, "user", f"{t}.{n}", s) for t, n, p, s in made], "tree long, node long, parent long, role string, text string, score double")
    got = defaultdict(list)
    for r in sorted(chat.paths(nodes, 2).collect(), key=lambda r: r.pos):
        got[r.tree, r["rank"]].append(r.node)
    assert dict(got) == {(1, 1): [0, 1, 3], (1, 2): [0, 2, 4, 5], (2, 1): [7], (3, 1): list(range(37))}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_reply_trees(spark, seed):
    rng = random.Random(seed)
    made = []
    for tree in range(25):
        for node in range(rng.randint(1, 14)):
            parent = None if node == 0 or rng.random() < 0.1 else rng.choice([node - 1, rng.randrange(node), 99 if rng.random() < 0.1 else 0])
            made.append((tree if tree else None, node, parent, rng.choice([None, 0.0, 1.0, 2.5, -1.0])))
    made += rng.sample(made, 5)  # rows that repeat
    nodes = spark.createDataFrame([(*m, "user", "t") for m in made], "tree long, node long, parent long, score double, role string, text string")
    want = {}
    for tree in {m[0] for m in made}:
        up = {n: (p, s or 0.0) for t, n, p, s in made if t == tree}
        leaves = []
        for leaf in set(up) - {p for p, _ in up.values()}:
            path, at = [], leaf
            while at in up:
                path.append(at)
                at = up[at][0]
            leaves.append((-sum(up[n][1] for n in path), leaf, path[::-1]))
        for rank, (_, leaf, path) in enumerate(sorted(leaves)[:3], 1):
            want[tree, rank] = (leaf, path)
    got = defaultdict(list)
    for r in sorted(chat.paths(nodes, 3).collect(), key=lambda r: r.pos):
        got[r.tree, r["rank"]].append((r.leaf, r.node))
    assert {k: (v[0][0], [n for _, n in v]) for k, v in got.items()} == want
    formatted = chat.format_paths(nodes, 3).collect()
    assert {(r.tree, r["rank"]): len(chat.read_turns(r.formatted)) for r in formatted} == {k: len(p) for k, (_, p) in want.items()}


def test_linear_conversations(spark):
    schema = "conv_id long, turn long, role string, text string"
    made = [(1, 0, "user", "a"), (1, 1, "assistant", None), (1, 1, "assistant", None), (1, None, None, "z"), (None, 0, "user", "q"), (2, 5, "assistant", "r"), (2, 3, "user", "</s>")]
    got = {r.tree: chat.read_turns(r.formatted) for r in chat.format_paths(chat.linear(spark.createDataFrame(made, schema))).collect()}
    assert got == {1: [("", "z"), ("user", "a"), ("assistant", ""), ("assistant", "")], None: [("user", "q")], 2: [("user", "</s>"), ("assistant", "r")]}
    assert chat.digests(chat.format_paths(chat.linear(spark.createDataFrame([], schema)))).count() == 0


# ---- 2


def test_url_rules(spark):
    urls = [
        "http://a.example.net/en/1?x", "HTTP://EXAMPLE.NET/de/", "https://net/", "https://net", "http://notnet.com/", "http://x.example.com/de/3#a", "http://x.org/fr/", "http://x.org/fr",
        "no scheme", None, "", "://only", "a://b://c/d?e#f", "http://planet/x",
    ]
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(df).collect()}
    assert got == {
        0: ("a.example.net", "/en/1", "example.net/en/", "allow"), 1: ("example.net", "/de/", "net/", "block"), 2: ("net", "/", "net/", "block"), 3: ("net", "", None, "allow"),
        4: ("notnet.com", "/", None, "allow"), 5: ("x.example.com", "/de/3", "example.com/de/", "block"), 6: ("x.org", "/fr/", "org/fr/", "allow"), 7: ("x.org", "/fr", None, "allow"),
        8: ("", "", None, "allow"), 9: ("", "", None, "allow"), 10: ("", "", None, "allow"), 11: ("only", "", None, "allow"), 12: ("b:", "//c/d", None, "allow"), 13: ("planet", "/x", None, "allow"),
    }
    assert url_filter.judge(df.limit(0)).count() == 0


def test_mined_url_rules(spark):
    made = [(i, f"http://h{i % 7}.shop.example/{'casino' if i % 4 == 0 else 'news'}/{i}?ref={i % 3}") for i in range(400)]
    df = spark.createDataFrame([*made, (900, "http://other.test/casino/x"), (901, "http://other.test/news/x"), (900, "http://other.test/casino/x")], "page_id long, url string")
    labels = spark.createDataFrame([(i, "block" if i % 4 == 0 else "allow") for i in range(300)], "page_id long, label string")
    got = url_filter.judge(df, rules={}, labels=labels, support=0.01).collect()
    assert len(got) == 403 and all(r.verdict == ("block" if r.path.startswith("/casino/") else "allow") for r in got)
    assert {r.mined for r in got if r.page_id == 900} == {"path:casino"}


def test_mined_rules_from_long_urls(spark):
    deep = "/".join("abcdefghijklmnopqrst")
    made = [(i, f"http://h{i % 7}.example/{deep}/s{i % 5}/?{'buy' if i % 3 == 0 else 'read'}=now&last") for i in range(300)]
    df = spark.createDataFrame([*made, (900, "http://other.test/x?buy=now")], "page_id long, url string")
    labels = spark.createDataFrame([(i, "block" if i % 3 == 0 else "allow") for i in range(200)], "page_id long, label string")
    got = {r.page_id: (r.verdict, r.mined) for r in url_filter.judge(df, rules={}, labels=labels, support=0.05).collect()}
    assert {i: got[i][0] for i in range(300)} == {i: "block" if i % 3 == 0 else "allow" for i in range(300)}
    assert got[900] == ("block", "query:buy=now")


def test_tokens_that_come_together_all_make_rules(spark):
    rows = [(["a", "b"], "block")] * 6 + [(["c"], "allow")] * 6 + [([], "allow")] * 8
    found = url_filter.mined_rules(spark.createDataFrame(rows, "tokens array<string>, label string"), 0.3, 0.9)
    assert {(*r.antecedent, r.said, r.confidence, r.support, r.rarest) for r in found.collect()} == {
        ("a", "block", 1.0, 0.3, "a"), ("b", "block", 1.0, 0.3, "b"), ("c", "allow", 1.0, 0.3, "c"),
    }


def test_mining_is_what_enumeration_finds(spark):
    rng = random.Random(21)
    tokens = "abcdefg"
    for support, confidence in ((0.02, 0.6), (0.1, 0.8)):
        rows = []
        for _ in range(120):
            held = sorted({rng.choice(tokens) for _ in range(rng.randint(0, 5))})
            rows.append((held, "block" if ("a" in held and "b" in held) or rng.random() < 0.2 else "allow"))
        least = max(5, math.ceil(support * len(rows)))
        sets = [set(c) for n in range(1, 8) for c in itertools.combinations(tokens, n)]
        found = {}
        for s in sets:
            n = sum(s <= set(t) for t, _ in rows)
            for said in ("allow", "block"):
                both = sum(s <= set(t) and label == said for t, label in rows)
                if both >= least and both / n >= confidence:
                    found[tuple(sorted(s)), said] = (both / n, both / len(rows))
        single = {t: sum(t in held for held, _ in rows) for t in tokens}
        kept = {
            (s, said, round(c, 9), round(p, 9), min(s, key=lambda t: (single[t], t))) for (s, said), (c, p) in found.items()
            if not any(set(x) < set(s) and y == said and found[x, y][0] >= c for x, y in found)
        }
        got = url_filter.mined_rules(spark.createDataFrame(rows, "tokens array<string>, label string"), support, confidence)
        assert kept and {(tuple(r.antecedent), r.said, round(r.confidence, 9), round(r.support, 9), r.rarest) for r in got.collect()} == kept


def test_many_tokens_nearly_always_together(spark):
    """Forty rows that share 25 tokens, each of which one row lacks: rules of one token say all, and longer ones nothing more."""
    tokens = [f"t{i:02}" for i in range(25)]
    rows = [([t for k, t in enumerate(tokens) if k != i], "block") for i in range(40)] + [(["x"], "allow")] * 10
    found = url_filter.mined_rules(spark.createDataFrame(rows, "tokens array<string>, label string"), 0.1, 0.9)
    assert {(*r.antecedent, r.said, r.confidence, round(r.support, 9)) for r in found.collect()} == {*((t, "block", 1.0, 39 / 50) for t in tokens), ("x", "allow", 1.0, 0.2)}


def test_groups_of_tokens_are_matched_without_their_products(spark):
    """Two groups of fifty tokens, a block only together: one rule decides, whichever of its tokens a url has."""
    url = lambda parts: "http://h.test/" + "/".join(parts)
    first, second = ([f"{k}{c}{d}z" for c in "klmno" for d in "abcdefghij"] for k in "ab")
    made = [(i, url(first), "allow") for i in range(20)] + [(20 + i, url(second), "allow") for i in range(20)] + [(40 + i, url(first + second), "block") for i in range(20)]
    df = spark.createDataFrame([(i, u) for i, u, _ in made] + [(900, url([first[3], second[7]])), (901, url([first[3]])), (902, url(["other"]))], "page_id long, url string")
    labels = spark.createDataFrame([(i, v) for i, _, v in made], "page_id long, label string")
    got = {r.page_id: (r.verdict, r.mined) for r in url_filter.judge(df, rules={}, labels=labels, support=0.1).collect()}
    assert all(got[i][0] == v for i, _, v in made)
    assert got[900] == ("block", f"path:{first[3]} path:{second[7]}") and got[901] == got[902] == ("allow", None)


def test_single_urls_make_no_rules(spark):
    made = [(i, f"http://h{i}.example/p{i}") for i in range(9)]
    labels = spark.createDataFrame([(i, "block") for i in range(4)], "page_id long, label string")
    df = spark.createDataFrame(made, "page_id long, url string")
    assert {r.verdict for r in url_filter.judge(df, rules={}, labels=labels).collect()} == {"allow"}
    more = spark.createDataFrame([(i, "block" if i < 5 else "allow") for i in range(9)], "page_id long, label string")
    got = url_filter.judge(df, rules={}, labels=more).collect()
    assert {r.mined for r in got} == {None}  # every token but the common host is met once


def test_odd_pages(spark):
    """Repeated and null page ids, null urls and labels, clashing columns; of equally sure rules the better supported decides."""
    made = [(1, "http://x.test/bad/1"), (1, "http://x.test/bad/1"), (1, "http://x.test/ok/1"), (None, "http://y.test/bad/2"), (None, None), (2, None)]
    made += [(10 + i, f"http://z{i % 3}.test/{'bad' if i % 2 else 'ok'}/{i}") for i in range(40)]
    df = spark.createDataFrame([(*r, "v", "k") for r in made], "page_id long, url string, verdict string, key string")
    labels = spark.createDataFrame([*((10 + i, "block" if i % 2 else "allow") for i in range(40)), (None, "block"), (11, None)], "page_id long, label string")
    got = sorted(((r.page_id, r.path, r.verdict) for r in url_filter.judge(df, rules={}, labels=labels).collect() if (r.page_id or 0) < 10), key=str)
    assert got == sorted([(1, "/bad/1", "block"), (1, "/bad/1", "block"), (1, "/ok/1", "allow"), (None, "/bad/2", "block"), (None, "", "allow"), (2, "", "allow")], key=str)


# ---- 1 and 3


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(5)
    hide = [lambda w: w, lambda w: w.replace("o", "0").replace("e", "3"), lambda w: " ".join(w), lambda w: w[:2] + w[1] * 4 + w[2:]]
    made, marks = [], []
    for i in range(600):
        w = [rng.choice(WORDS) for _ in range(rng.randint(8, 60))]
        toxic = i % 5 == 0
        good = i % 7 != 0
        if toxic:
            bad = rng.choice(["zorgole", "morkel", "grelon"])
            w.insert(rng.randint(0, len(w)), hide[i // 5 % 4](bad) if i % 3 == 1 and good else bad)
        text = " ".join(w) if good else " ".join(x.upper() + "!!" for x in w)
        made.append((i, text))
        marks.append((i, int(good), int(toxic)))
    docs = spark.createDataFrame([*made, (1000, None), (1001, ""), (None, "zorgole"), (1002, words(4000))], "doc_id long, text string").repartition(3)
    return docs, spark.createDataFrame(marks, "doc_id long, quality int, toxic int")


def test_toxicity_on_held_out_rows(labelled):
    docs, labels = labelled
    marks = {r.doc_id: r.toxic for r in labels.collect()}
    got = toxicity.score(docs, labels, lambda c: c % 3 == 1).collect()
    assert len(got) == 604 and all(0 <= r.score <= 1 for r in got)
    held = [(r.predicted, marks[r.doc_id]) for r in got if r.held_out and r.doc_id in marks]
    assert sum(p == m for p, m in held) / len(held) > 0.97
    assert toxicity.score(docs.limit(0), labels).count() == 0
    assert {r.predicted for r in toxicity.score(docs, labels.limit(0)).collect()} == {0}


def test_restoring(labelled):
    counts = np.zeros(1 << 20, np.int64)
    for t in ["idiot moron stupid clown"] * 50 + [" ".join(WORDS)]:
        counts += np.bincount(toxicity.four_grams(toxicity.classed(t)), minlength=1 << 20)
    restorer = toxicity.Restorer(toxicity.LanguageModel(counts))
    told = restorer.words(["an 1d10t, m0r0n", "stuuuupid", "c l o w n !", "i.d.i.o.t", None or "", "plain"])
    assert {"idiot", "moron"} <= told[0] and "stupid" in told[1] and "clown" in told[2] and "idiot" in told[3] and told[4] == set() and told[5] == {"plain"}


def test_restoring_long_stretches():
    counts = np.zeros(1 << 20, np.int64)
    text = "the people say you are an idiot the clown is stupid the things are stupid you say the clown is an idiot"
    for t in [text] * 50:
        counts += np.bincount(toxicity.four_grams(toxicity.classed(t)), minlength=1 << 20)
    model = toxicity.LanguageModel(counts)
    bare = text.replace(" ", "")
    made = ["st" + "u" * 90 + "pid", " ".join(bare), ".".join(bare), ".".join(bare * 60), "1d10t" + "people" * 20]
    told = toxicity.Restorer(model).words(made)
    assert "stupid" in told[0] and all(set(text.split()) <= t for t in told[1:4]) and "idiot" + "people" * 20 in told[4]
    # one reading whether it is joined on the way or not
    long = toxicity.restore(".".join(bare * 60), model)
    assert len(long) > 3000 and long.replace(" ", "") == bare * 60 and set(long.split()) <= set(text.split())
    assert toxicity.restore("i" + "d" * 300_000 + "iot", model) == "idiot"


def test_restoring_is_the_best_of_all_paths():
    """Every path of small lattices is enumerated and scored."""
    counts = np.zeros(1 << 20, np.int64)
    for t in ["stupid idiot clown loser ass hello list silly"] * 20 + [" ".join(WORDS[:50])]:
        counts += np.bincount(toxicity.four_grams(toxicity.classed(t)), minlength=1 << 20)
    model = toxicity.LanguageModel(counts)
    rng = random.Random(4)

    def every(span):
        classes = toxicity.classed(span).tolist()
        spaced = len(span) > 2 and all(c == toxicity._SEP for c in classes[1::2])
        done, ahead = {}, [(0, 0, 0.0, "")]
        while ahead:
            i, s, value, text = ahead.pop()
            if i == len(span):
                value += float(model.log[s, 0]) if s & 31 else 0.0
                done[text] = max(done.get(text, -1e9), value)
                continue
            end = i + 1
            while end < len(span) and span[end] == span[i]:
                end += 1
            for letters, add, cost, after in toxicity.arcs_at(span, i, end, classes[i], spaced):
                t, v = s, value + cost
                for k in letters:
                    if k or t & 31:
                        v += float(model.log[t, k])
                        t = ((t << 5) | k) & 0x7FFF
                ahead.append((after, t, v, text + add))
        return done

    spans = ["1d10t", "5tup1d", "l0ooser", "a$$", "с1оwn", "heeello", "l.1.s.t", "s i l l y", "aaa", "1l1", "$1lly", "x|x!"]
    spans += ["".join(rng.choice("a1lo0s$5e!cс") for _ in range(rng.randint(2, 7))) for _ in range(60)]
    for span in spans:
        paths, read = every(span), toxicity.restore(span, model)
        assert read in paths and paths[read] >= max(paths.values()) - 1e-5, span


def test_restoring_other_scripts_and_gaps():
    counts = np.zeros(1 << 20, np.int64)
    for t in ["that clown is an idiot and a bad loser", "хорошо это слово"] * 50:
        counts += np.bincount(toxicity.four_grams(toxicity.classed(t)), minlength=1 << 20)
    restorer = toxicity.Restorer(toxicity.LanguageModel(counts))
    made = {"ｉｄｉｏｔ": "idiot", "clоwn": "clown", "idiоt!": "idiot", "b a d": "bad", "c  l  o  w  n": "clown", "l -- o -- s -- e -- r": "loser", "𝐜𝐥𝐨𝐰𝐧": "clown", "хорошо": "хорошо"}
    told = restorer.words(list(made))
    assert [(m, w) for (m, w), t in zip(made.items(), told, strict=True) if w not in t] == []
    assert told[-1] == {"хорошо"}


def test_toxicity_of_odd_rows(spark, labelled):
    """Clashing columns, repeated rows and ids, null labels."""
    docs, labels = labelled
    more = spark.createDataFrame([(5, "zorgole"), (5, "zorgole"), (7000, "z0rg0le is here"), (7001, "fine words here")], "doc_id long, text string")
    df = docs.unionByName(more).selectExpr("*", "1 as toxic", "'x' as score", "0 as held_out", "'y' as row", "'z' as telling")
    marks = labels.unionByName(spark.createDataFrame([(None, 1, 1), (7001, 1, None), (3, 1, 0), (3, 1, 0)], labels.schema)).selectExpr("*", "'t' as text")
    got = toxicity.score(df, marks).collect()
    assert len(got) == 608 and {r.predicted for r in got if r.doc_id == 7000} == {1} and {r.predicted for r in got if r.doc_id == 7001} == {0}
    assert len({r.score for r in got if r.doc_id == 5}) == 2
    rated = quality.resample(df, marks).collect()
    assert len(rated) == 608 and len({r.sample_key for r in rated if r.doc_id == 5}) == 2
    assert quality.select(df, marks).columns == df.columns


def test_restoring_at_the_edges():
    counts = np.zeros(1 << 20, np.int64)
    for t in ["that idiot said what they hate", "die shit ass", "the asshole is a loser", "covid and mp and a b c"] * 50:
        counts += np.bincount(toxicity.four_grams(toxicity.classed(t)), minlength=1 << 20)
    restorer = toxicity.Restorer(toxicity.LanguageModel(counts))
    made = {
        "idio7": "idiot", "hat3": "hate", "di3": "die", "a$$": "ass", "shi7": "shit", "4$$hole": "asshole", "1053r": "loser",
        "d i e": "die", "a.s.s": "ass", "1 d 1 0 7": "idiot", "covid19": "covid19", "mp3!": "mp3", "a b c": "b", "what!": "what", "(hate)": "hate",
    }
    told = restorer.words(list(made))
    assert [(m, w) for (m, w), t in zip(made.items(), told, strict=True) if w not in t] == []
    assert told[-2] == {"what"} and told[-1] == {"hate"}


def test_quality_selection(labelled):
    docs, labels = labelled
    good = {r.doc_id: r.quality for r in labels.collect()}
    got = quality.resample(docs, labels).collect()
    assert len(got) == 604
    rated = [(r.kept, good[r.doc_id] == 1) for r in got if r.doc_id in good]
    assert sum(a == b for a, b in rated) / len(rated) > 0.98
    assert all(r.kept for r in quality.resample(docs, labels.filter("quality = 0")).collect())
    assert quality.resample(docs.limit(0), labels).count() == quality.select(docs.limit(0), labels).count() == 0
    kept = {r.doc_id for r in got if r.kept}
    assert {r.doc_id for r in quality.select(docs, labels).collect()} == kept


def test_weights_are_the_models_log_ratios(labelled):
    """A plain recount of both models, every weight, and which rows the k largest keys are."""
    docs, labels = labelled
    texts, mark = [(r.doc_id, r.text or "") for r in docs.collect()], {r.doc_id: r.quality for r in labels.collect()}
    grams = [quality.hashed_ngrams([t])[0].tolist() for _, t in texts]
    raw, target = defaultdict(int), defaultdict(int)
    for (i, _), g in zip(texts, grams, strict=True):
        for b in g:
            raw[b] += 1
            target[b] += mark.get(i) == 1
    n, m, size = sum(raw.values()), sum(target.values()), quality.BUCKETS
    ratio = {b: math.log((target[b] + size * c / n) / (m + size) / (c / n)) for b, c in raw.items()}
    plain = {i: sum(map(ratio.get, g)) for (i, _), g in zip(texts, grams, strict=True)}
    whole = quality.resample(docs, labels, k=250, reach=None).collect()
    assert all(math.isclose(r.log_weight, plain[r.doc_id], rel_tol=1e-7, abs_tol=1e-8 * (100 + r.n_grams)) for r in whole)
    want = {i: plain[i] if len(g) <= 100 else 100 * plain[i] / len(g) for (i, _), g in zip(texts, grams, strict=True)}
    got = quality.resample(docs, labels, k=250).collect()
    assert all(abs(r.log_weight - want[r.doc_id]) < 1e-6 and r.n_grams == len(g) for r in got for (i, _), g in zip(texts, grams, strict=True) if i == r.doc_id)
    assert {r.doc_id for r in got if r.kept} == {r.doc_id for r in sorted(got, key=lambda r: -r.sample_key)[:250]}


def test_noise_decides_between_close_weights(spark, labelled):
    """Of short texts as many are drawn as their weights say; junk stays out."""
    docs, labels = labelled
    made = [(10_000 + i, "ab cdefg" if i % 2 else "hgf e") for i in range(4000)] + [(20_000 + i, "HGF!! E!! " * 30) for i in range(300)]
    got = quality.resample(docs.unionByName(spark.createDataFrame(made, "doc_id long, text string")), labels, k=1500).collect()
    close = [r for r in got if r.doc_id and 10_000 <= r.doc_id < 20_000]
    assert not any(r.kept for r in got if r.doc_id and r.doc_id >= 20_000)
    kept, weights = np.array([r.kept for r in close]), np.array([r.log_weight for r in close])
    assert 500 < kept.sum() < 1500 and len(set(weights)) == 2
    cut = max(r.sample_key for r in got if not r.kept)
    for w in set(weights):  # a Gumbel key passes the cut with this chance
        share = 1 - math.exp(-math.exp(w - cut))
        assert abs(kept[weights == w].mean() - share) < 4 * math.sqrt(share * (1 - share) / 2000) + 0.01
    assert 0 < sum(k != (w == max(weights)) for k, w in zip(kept, weights, strict=True))


def test_top_k_cut(spark, monkeypatch):
    monkeypatch.setattr(quality, "FEW", 5)
    keys = [(float(i % 50), i) for i in range(1000)]
    df = spark.createDataFrame(keys, "key double, tie long")
    for k in (1, 19, 20, 21, 500, 1000):
        want = sorted(keys, key=lambda x: (-x[0], x[1]))[k - 1]
        assert quality.cut_of_top_k(df, k) == want
    assert quality.cut_of_top_k(df, 0) is None and quality.cut_of_top_k(df, 1001) is None


def test_gumbel_draws_by_weight(spark):
    from pyspark.sql import functions as F

    df = spark.range(20000).withColumn("w", F.when(F.col("id") % 2 == 0, math.log(3.0)).otherwise(0.0))
    first = df.withColumn("key", F.col("w") + quality.gumbel(F.col("id"), 1)).groupBy((F.col("id") / 2).cast("long")).agg(F.max_by(F.col("id") % 2, "key").alias("odd"))
    assert abs(first.filter("odd = 0").count() / 10000 - 0.75) < 0.02
