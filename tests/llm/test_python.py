"""The other operators against brute force, libraries, round trips and held-out accuracy."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lodestrata.llm import line_templates, neighbours, packing, pii, sentencepiece_bpe, simhash, suffix_dedup


# --- suffix dedup


def brute_repeats(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        out.append((len(t), int(gone.sum()), int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize(("length", "gram"), [(30, 12), (30, 29), (200, 64)])
def test_repeats(spark, length, gram):
    rng = random.Random(length)
    piece = lambda n: "".join(rng.choice("ab") for _ in range(n))
    known = [piece(60) for _ in range(6)]
    texts = [None, "", "a" * 500, "a" * 700, "abc" * 200, "é" * 300] + ["".join(rng.choice(known) if rng.random() < 0.6 else piece(rng.randint(1, 50)) for _ in range(rng.randint(1, 9))) for _ in range(80)]
    texts.append(texts[20])
    ids = [*range(len(texts) - 1), 20]
    ids[7] = None
    df = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string").withColumn("h", F.lit(1))
    got = Counter(tuple(r) for r in suffix_dedup.dedup(df, length, gram).collect())
    assert got == Counter((i, *b) for i, b in zip(ids, brute_repeats([(t or "").encode() for t in texts], length), strict=True))


def test_repeats_edges(edge, nothing, sample):
    rows = edge.collect()
    got = Counter(tuple(r) for r in suffix_dedup.dedup(edge).collect())
    assert got == Counter((r.doc_id, *b) for r, b in zip(rows, brute_repeats([(r.text or "").encode() for r in rows], 200), strict=True))
    assert suffix_dedup.dedup(nothing).count() == 0
    rows = sample.collect()
    full = {r.doc_id: r for r in suffix_dedup.dedup(sample, texts=True).collect()}
    for r, b in zip(rows, brute_repeats([r.text.encode() for r in rows], 200), strict=True):
        f = full[r.doc_id]
        assert (f.n_bytes, f.n_removed, f.n_spans, f.kept_sha256) == b
        assert hashlib.sha256(bytes(f.kept)).hexdigest() == b[3]
        assert suffix_dedup.without(r.text.encode(), [tuple(s) for s in f.spans]) == bytes(f.kept)


def test_long_texts_are_sliced():
    text = bytes(random.Random(1).choices(b"abcd", k=5000))
    parts = [p for c in suffix_dedup.slices([text, b"", text[:10]], 50, chunk=700) for p in c]
    starts = [i + a for _, a, p in parts for i in range(len(p) - 49)]
    assert sorted(starts) == list(range(5000 - 49))


def test_suffix_sort_and_collisions(monkeypatch):
    rng = random.Random(3)
    texts = [bytes(rng.choices(b"ab", k=rng.randint(0, 40))) for _ in range(120)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    size = np.array([len(t) for t in texts])
    first, count = np.array([0, 50, 51]), np.array([50, 1, 69])

    def check():
        order, shared = suffix_dedup.Suffixes(data, np.cumsum(size) - size, size).sorted_with_common(first, count)
        for a, n in zip(first, count, strict=True):
            own = order[a : a + n]
            assert [texts[i] for i in own] == sorted(texts[a : a + n])
            for k in range(1, n):
                x, y = texts[own[k - 1]], texts[own[k]]
                assert shared[a + k] == next((i for i, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))

    check()
    monkeypatch.setattr(suffix_dedup.Hashes, "of", lambda self, start, length: np.zeros(len(start), np.uint64))  # every hash collides
    check()


# --- simhash


def test_fingerprints(edge, nothing):
    for r in simhash.fingerprints(edge.withColumn("key", F.monotonically_increasing_id()), 3, ["key"]).join(edge.withColumn("key", F.monotonically_increasing_id()).select("key", "text"), "key").collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r.text or ""))
        grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        assert r.fp & (2**64 - 1) == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash.components(nothing).count() == 0


def brute_components(fps, threshold):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    fps = sorted(set(fps))
    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= threshold:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


@pytest.mark.parametrize(("threshold", "blocks", "reach"), [(2, 2, None), (2, 1, None), (4, 2, 2), (1, 1, 1)])
def test_links(spark, threshold, blocks, reach):
    rng = random.Random(threshold * 10 + blocks)
    fps = [0]
    for _ in range(40):
        f = rng.getrandbits(64)
        for _ in range(rng.randint(1, 6)):
            fps.append(f)
            f ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, threshold + 1)))
    fps = [f - 2**64 if f >> 63 else f for f in fps]
    edges = simhash.links(spark.createDataFrame([(f,) for f in set(fps)], "fp long"), threshold, blocks, reach)
    roots = {r.node: r.root for r in simhash.common.connected_components(edges).collect()}
    expected = brute_components(fps, threshold)
    assert {f: roots.get(f, f) for f in expected} == expected


def test_local_roots_of_large_groups():
    rng = np.random.default_rng(5)
    fp = np.unique(np.concatenate([rng.integers(0, 2**63, 300).astype(np.uint64) ^ (np.uint64(1) << np.uint64(b)) for b in range(40)] + [rng.integers(0, 2**63, 300).astype(np.uint64)]))
    root = simhash.local_roots(fp, 2)
    assert len(fp) > 8192
    expected = brute_components([int(f) for f in fp[:400]], 2)
    small = simhash.local_roots(fp[:400], 2)
    assert [int(fp[i]) for i in small] == [expected[int(f)] for f in fp[:400]]
    signed = fp.view(np.int64)
    assert (signed[root] <= signed).all()
    least = np.arange(len(fp))  # brute force: every pair, until nothing changes
    linked = [np.flatnonzero(np.bitwise_count(fp ^ f) <= 2) for f in fp]
    changed = True
    while changed:
        before = least.copy()
        for i, near in enumerate(linked):
            least[i] = least[near[np.argmin(signed[least[near]])]]
        changed = bool((least != before).any())
    assert (signed[least] == signed[root]).all()


def test_near_dedup(edge):
    kept = simhash.dedup(edge)
    assert kept.columns == edge.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(1) == 1
    assert not {2, 6} & set(ids)  # copies of 1 but for a blank
    assert len([i for i in ids if i in (3, 4, 5)]) == 1  # texts without words


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_wide_fingerprint(edge):
    for text in {r.text or "" for r in edge.collect()}:
        hashes = [xxhash.xxh3_128_intdigest(g, 42) for g in shingles(text)]
        ones = [2 * sum(h >> b & 1 for h in hashes) + (min(hashes, default=0) >> b & 1) for b in range(128)]
        assert int.from_bytes(simhash.wide_fingerprint(text), "big") == sum(1 << b for b, k in enumerate(ones) if k > len(hashes))


def test_wide_links(spark):
    """Within an anchor all that is near is connected, small anchors and large; links are true ones; what is very near always meets."""
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 2**63, (30, 2)).astype(np.uint64)
    fp = [centres, np.array([[0, 0]], np.uint64)]
    for bits in (1, 2, 4):
        for _ in range(20):
            moved = centres.copy()
            for i in range(30):
                for b in rng.choice(128, bits, replace=False):
                    moved[i, b // 64] ^= np.uint64(1 << int(b % 64))
            fp.append(moved)
    fp = np.unique(np.concatenate(fp), axis=0)
    edges = simhash.wide_links(spark.createDataFrame([(bytearray(f.tobytes()),) for f in fp], "fp binary"), 8, 2).collect()
    bits = lambda x, y: (int.from_bytes(x, "big") ^ int.from_bytes(y, "big")).bit_count()
    assert edges and max(bits(e.a, e.b) for e in edges) <= 8
    roots = {bytes(r.node): bytes(r.root) for r in simhash.common.connected_components(spark.createDataFrame(edges, "a binary, b binary")).collect()}
    own = [f.tobytes() for f in fp]
    assert len({roots.get(f, f) for f in own}) == 31
    order = np.zeros(len(fp), np.int64)
    a, b = simhash._wide_links(order, fp, 8)  # one large anchor
    local = {bytes(r.node): bytes(r.root) for r in simhash.common.connected_components(spark.createDataFrame([(bytearray(x.tobytes()), bytearray(y.tobytes())) for x, y in zip(a, b, strict=True)], "a binary, b binary")).collect()}
    assert len({local.get(f, f) for f in own}) == 31


def test_near_copies(spark):
    """Against brute force on similarity: nine in ten of the pairs of similarity 0.8 or more meet, and texts that share little never do."""
    rng = random.Random(8)
    texts = []
    for _ in range(150):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(60, 300))]
        texts.append(" ".join(words))
        for _ in range(2):
            for _ in range(max(1, len(words) // 60)):
                words[rng.randrange(len(words))] = f"v{rng.randrange(3000)}"
            texts.append(" ".join(words))
    own = [shingles(t) for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    root = {r.doc_id: r.component_id for r in simhash.near_components(df).collect()}
    near = [(i, j) for i in range(len(texts)) for j in range(i) if len(own[i] & own[j]) >= 0.8 * len(own[i] | own[j])]
    assert len(near) > 100
    assert sum(root[i] == root[j] for i, j in near) >= 0.9 * len(near)
    assert all(root[i] // 3 == i // 3 for i in root)
    assert simhash.near_components(df.limit(0)).count() == 0


# --- packing


def check_pieces(rows, df, capacity):
    at, seq = defaultdict(list), defaultdict(list)
    for r in rows:
        at[r.doc_id].append(r)
        seq[r.sequence_id].append(r)
    assert sorted(seq) == list(range(len(seq)))
    for own in seq.values():
        offset = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == offset
            offset += r.length
        assert offset <= capacity
    encoding = packing.encoder(packing.default_vocabulary())
    for r in df.collect():
        ids = packing.token_ids(encoding, r.text or "")
        found = [p for p in at[r.doc_id] if p.doc_tokens == len(ids)]
        starts = Counter((p.start, p.length, p.ids_crc32) for p in found)
        for at_ in range(0, len(ids), capacity):
            part = ids[at_ : at_ + capacity]
            assert starts[at_, len(part), zlib.crc32(part.tobytes())] >= 1
    assert sum(r.length for r in rows) == sum(len(packing.token_ids(encoding, r.text or "")) for r in df.collect())
    return sum(r.length for r in rows) / (len(seq) * capacity)


def test_packing(edge, nothing, sample):
    check_pieces(packing.pack(edge).collect(), edge, 1024)
    assert check_pieces(packing.pack(sample).collect(), sample, 1024) > 0.97
    assert packing.pack(nothing).count() == 0


def test_ids_are_those_of_the_library(sample):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(packing.default_vocabulary())
    encoding = packing.encoder(packing.default_vocabulary())
    for t in ["", " a  b\n\n c<|endoftext|>d", "I'm 123 été x\t\t y", "漢字 🙂🙂", "aaaa" * 500, *(r.text for r in sample.limit(60).collect())]:
        assert [*library.encode(t, add_special_tokens=False).ids, 0] == packing.token_ids(encoding, t).tolist()


@pytest.mark.parametrize("run", [" ", "\n", "\u3000", " \n"])
@pytest.mark.parametrize("after", ["", "a", " a", "<|endoftext|>", "!", "1"])
def test_long_blanks(run, after):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(packing.default_vocabulary())
    t = f"x{run * 12_000}{after}{run * 11_000}y"
    assert [*library.encode(t, add_special_tokens=False).ids, 0] == packing.token_ids(packing.encoder(packing.default_vocabulary()), t).tolist()


@pytest.mark.parametrize("char", [" ", "\n", "a", "1", "!", "é"])
def test_megabytes_of_one_character(char):
    encoding = packing.encoder(packing.default_vocabulary())
    ids = packing.token_ids(encoding, char * 5_000_000)
    assert encoding.decode(ids[:-1].tolist()) == char * 5_000_000


def test_fill_is_closest():
    rng = random.Random(2)
    for _ in range(200):
        counts = {rng.randint(1, 30): rng.randint(1, 3) for _ in range(rng.randint(0, 6))}
        room = rng.randint(0, 60)
        used = packing.fill(counts, room)
        sums = {0}
        for k, n in counts.items():
            sums = {s + k * i for s in sums for i in range(n + 1)}
        assert sum(k * n for k, n in used.items()) == max(s for s in sums if s <= room)
        assert all(n <= counts[k] for k, n in used.items())


# --- SentencePiece


def test_sentencepiece(edge, nothing):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_bpe.default_model())
    rng = random.Random(1)
    parts = ["a", "b", "the", " ", "  ", "\n", "e", "r", "er", "in", "é", "漢", "龘", "🙂", "▁", "aaaa", "<0x41>", "<s>", "\t", "1", "000", "\x00", "!!", "ing", "zzzzzzzzz", "\xa0", "</s>"]
    texts = [" ", "", "   a", "a" * 3000, "ab" * 2000, " " * 9001, "x" + " " * 700 + "y" + " " * 5000, *("".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(1500))]
    m = sentencepiece_bpe.model(sentencepiece_bpe.default_model())
    words = [m.words(t) for t in texts]
    ids = iter(m.encode_words([w for t in words for w in t]))
    for t, own in zip(texts, words, strict=True):
        got = [i for _ in own for i in next(ids)]
        assert got == library.encode(t)
        assert m.decode(got) == library.decode(got)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    expected = Counter()
    for r in edge.collect():
        i = library.encode(r.text or "")
        expected[(r.doc_id, len(i), sha(",".join(map(str, i))), sha(library.decode(i)))] += 1
    assert Counter(tuple(r) for r in sentencepiece_bpe.digest(edge).collect()) == expected
    assert Counter((r.doc_id, tuple(r.ids)) for r in sentencepiece_bpe.encode(edge).collect()) == Counter((r.doc_id, tuple(library.encode(r.text or ""))) for r in edge.collect())
    assert sentencepiece_bpe.digest(nothing).count() == 0


def test_memo_is_bounded(monkeypatch):
    monkeypatch.setattr(sentencepiece_bpe, "MEMO_BYTES", 2000)
    words = sentencepiece_bpe.Memo(sentencepiece_bpe.default_model())
    expected = lambda t: sum(len(x) for x in words.model.encode_words(words.model.words(t)))
    for t in ("the cat sat on the mat " * 3, "x" * 5000, " ".join(f"w{i}" for i in range(200)), "the cat " + "y" * 300 + " sat"):
        (found,) = words.look_up([words.model.words(t)])
        assert sum(f[0] for f in found) == expected(t)
        assert all(len(w) <= sentencepiece_bpe.MEMO_WORD for w in words.known)
    assert len(words.known) < 10


# --- personal data


def brute_spans(text):
    out = []
    for kind, pattern in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and max(map(int, m[0].split("."))) > 255 or kind == "card" and not (16 <= len(digits) <= 19 and pii.luhn(digits)) or kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


def test_personal_data(edge, nothing, sample):
    finder = pii.automaton()
    rng = random.Random(3)
    parts = ["1", "2", "45", ".", ".", "@", "+", "-", " ", "a", "(", "%", "é", "İ", "4111 1111 1111 1111", "255", "\n", "1.2.3.4"]
    for t in ["".join(rng.choice(parts) for _ in range(rng.randint(1, 22))) for _ in range(20_000)]:
        assert [s for s in pii.spans(t, finder) if s[0] in pii.BASE] == brute_spans(t)
    for df in (edge, sample):
        for r in pii.find(df).join(df.select("doc_id", "text"), "doc_id").collect():
            base = [s for s in r.spans.split(",") if s.split(":")[0] in pii.BASE]
            assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
    assert pii.find(nothing).count() == pii.redact(nothing).count() == 0


@pytest.mark.parametrize(("text", "kinds"), [("IBAN: DE89 3704 0044 0532 0130 00.", ["account"]), ("IBAN: DE89 3704 0044 0532 0130 01.", []), ("account number 12345678", ["account"]), ('token = "1eb9c654e721b4f8"', ["secret"]), ("the token of it", []), ("see https://u:p@x.org/a", ["email", "url"]), ("see https://x.org/a", []), ("mailto:me@x.org", ["email", "url"])])
def test_added_kinds(text, kinds):
    assert sorted({s[0] for s in pii.spans(text, pii.automaton())} - {"card"}) == kinds


def test_redaction(spark, edge):
    df = spark.createDataFrame([(1, "a me@x.org b 1.2.3.4", 9), (2, None, 0)], "doc_id long, text string, n_chars long")
    assert [tuple(r) for r in pii.redact(df).orderBy("doc_id").collect()] == [(1, "a [EMAIL] b [IP]", 16), (2, None, None)]
    assert pii.redact(edge).columns == edge.columns
    assert pii.redact(edge).count() == edge.count()


# --- classifier


def test_votes(spark, edge, nothing):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    space = neighbours.fit(docs, labels)
    rows = neighbours.score(docs, space).join(labels, "doc_id").where(neighbours.held_out(F.col("doc_id"))).collect()
    assert sum((r.score >= 0.5) == (r.quality == 1) for r in rows) / len(rows) >= 0.95
    assert len(space.labels) <= neighbours.LABELLED
    scores = [r.score for r in neighbours.score(edge, space).collect()]
    assert len(scores) == edge.count()
    assert all(0 <= s <= 1 for s in scores)
    assert neighbours.score(nothing, space).count() == 0
    empty = neighbours.fit(nothing, labels.limit(0))
    assert {r.score for r in neighbours.score(edge, empty).collect()} == {0.5}
    odd = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (4, None)], "doc_id long, quality int")
    assert set(neighbours.fit(edge, odd).labels.tolist()) <= {1.0}


def test_votes_are_exact():
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 3, (60, neighbours.BUCKETS + 1)).astype(np.float32)
    space = neighbours.Space(counts[:40], (rng.random(40) > 0.3).astype(float), rank=8)
    got = space.scores(counts[40:], 5)
    vectors = space._unit(space._weighted(counts[40:]) @ space.axes)
    for v, s in zip(vectors, got, strict=True):
        cosine = space.vectors @ v
        near = np.argsort(-cosine, kind="stable")[:5]
        w = np.maximum(cosine[near], 0).astype(float) ** neighbours.POWER
        assert s == pytest.approx(((w * space.labels[near]).sum() + neighbours.PRIOR * space.prior) / (w.sum() + neighbours.PRIOR), rel=1e-5)


def test_ties_go_to_the_smaller_row():
    rng = np.random.default_rng(4)
    cosine = rng.integers(0, 4, (200, 30)).astype(np.float32) / 4  # many ties
    for k in (1, 7, 29, 30):
        assert neighbours.nearest(cosine, k).tolist() == [sorted(np.argsort(-row, kind="stable")[:k].tolist()) for row in cosine]


# --- line templates


def brute_lines(rows, least=line_templates.LEAST, long=None):
    """Numbers of the dropped lines of each document (doc_id, text), by comparing every template with every group of its node."""
    documents = list(dict.fromkeys((r.doc_id, r.text) for r in rows))
    order = lambda d: (d[0] is None, d[0] or 0, line_templates._signed(xxhash.xxh64_intdigest(d[1] or "", 42)))
    holders, nodes = defaultdict(set), defaultdict(set)
    for d in documents:
        for line in (d[1] or "").split("\n"):
            if words := tuple("<*>" if re.search("[0-9]", w) else w for w in line.split()):
                holders[words].add(d)
                nodes[len(words), words[:3]].add(words)
    drop = {}
    for templates in nodes.values():
        groups = []
        for t in sorted(templates, key=lambda t: (-min(len(holders[t]), least), " ".join(t))):
            fixed = sum(w != "<*>" for w in t)
            shares = [sum(a == b != "<*>" for a, b in zip(t, g, strict=True)) / max(fixed, 1) for g, _ in groups]
            if shares and max(shares) >= line_templates.SIMILAR:
                i = shares.index(max(shares))
                groups[i][0][:] = [a if a == b else "<*>" for a, b in zip(groups[i][0], t, strict=True)]
                groups[i][1].append(t)
            else:
                groups.append((list(t), [t]))
        for _, own in groups:
            docs = set().union(*(holders[t] for t in own))
            if len(docs) >= least or long and len(own[0]) >= long and len({d[1] for d in docs}) > 1:
                drop |= dict.fromkeys(own, docs)
    out = {}
    for d in documents:
        lines = [tuple("<*>" if re.search("[0-9]", w) else w for w in x.split()) for x in (d[1] or "").split("\n")]
        out[d] = [i for i, x in enumerate(lines) if x in drop and d != min(drop[x], key=order)]
    return out


def documents_with_numbers(df, long):
    docs = df.select("doc_id", "text").distinct().withColumn("hash", line_templates.text_hash())
    hit = line_templates._dropped(df, line_templates.LEAST, line_templates.SIMILAR, long).distinct()
    same = docs.doc_id.eqNullSafe(hit.doc_id) & docs.hash.eqNullSafe(hit.text_hash)
    return {(r.doc_id, r.text): list(r.dropped) for r in docs.join(hit, same).select(docs.doc_id, "text", "dropped").collect()}


def test_templates(spark, edge, nothing, sample):
    rng = random.Random(6)
    line = lambda: " ".join(rng.choice(["sent by", "from"]).split() + [rng.choice("abcdefgh") for _ in range(rng.choice([3, 8, 9]))] + [rng.choice(["x1", "y", "z"])])
    made = [(rng.choice([None, *range(60)]), "\n".join(line() for _ in range(rng.randint(1, 5)))) for _ in range(200)]
    made = spark.createDataFrame(made + rng.sample(made, 40), "doc_id long, text string")
    for df in (edge, sample, made, sample.unionByName(sample).select("doc_id", "text")):
        for long in (None, line_templates.LONG):
            assert documents_with_numbers(df, long) == brute_lines(df.collect(), long=long)
    assert sum(map(len, documents_with_numbers(made, None).values())) > 10
    out = {(r.doc_id, r.n_chars): r.text for r in line_templates.dedup(edge).collect()}
    assert "line a 12\nline b\nline a 13\n\nline b" in out.values()
    assert out[10, 5], out[3, None] == ("other", None)
    assert line_templates.dedup(edge).columns == edge.columns
    assert line_templates.dedup(edge).count() == edge.count()
    assert line_templates.dedup(nothing).count() == 0


def test_lines_count_documents(spark):
    """A stored copy of a row and a second variant within a document do not make a line recur."""
    twice = [(1, "a common line here\nx"), (1, "a common line here\nx"), (2, "a common line here\ny")]
    variants = [(1, "sent on behalf of alice to all readers today\nsent on behalf of bob to all readers today"), (2, "sent on behalf of carol to all readers today\nz")]
    for rows in (twice, variants):
        out = Counter(tuple(r) for r in line_templates.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect())
        assert out == Counter(rows)
    third = [*variants, (3, "sent on behalf of dave to all readers today\nw")]
    out = {r.doc_id: r.text for r in line_templates.dedup(spark.createDataFrame(third, "doc_id long, text string")).collect()}
    assert out == {1: variants[0][1], 2: "z", 3: "w"}


def test_merging_generalises():
    same = [("Released under the MIT License today ok", 5), ("Released under the BSD License today ok", 2), ("Released under the moon you see it", 1)]
    heads = line_templates.merged(same)
    assert heads[0] == heads[1] == 0
    assert heads[2] == 2
    many = [(f"a b c d{i:03d}x x y z w v u", 1) for i in range(600)]
    assert set(line_templates.merged(many)) == {0}


def test_order_does_not_matter(spark):
    rows = [(i, f"alpha beta gamma delta {w} zeta") for i, w in enumerate("pqrstu")]
    a = line_templates.dropped(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()
    b = line_templates.dropped(spark.createDataFrame(rows[::-1], "doc_id long, text string")).orderBy("doc_id").collect()
    assert a == b


def test_large_nodes_merge_alike(monkeypatch):
    for n in (256, 257, 3000):
        assert set(line_templates.merged([(f"Posted on behalf name{i:04d}x for the whole community newsletter team", 1) for i in range(n)])) == {0}
    rng = random.Random(4)
    kinds = [[rng.choice("abcdefgh") for _ in range(11)] for _ in range(60)]
    many = {" ".join(w if rng.random() < 0.85 else rng.choice([*"abcdefgh", line_templates.VARIABLE]) for w in rng.choice(kinds)): rng.randint(1, 4) for _ in range(1500)}
    got = line_templates.merged(list(many.items()))
    monkeypatch.setattr(line_templates, "NODE", 10**9)
    assert got == line_templates.merged(list(many.items()))
    assert 60 <= len(set(got)) < len(many) > 256


def test_long_lines_in_two_documents(spark):
    passage = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(50))
    rows = [(1, f"first one\n{passage}"), (2, f"{passage}\nanother text"), (3, "a short line\nx"), (4, "y\na short line"), (5, f"{passage} copy\nz"), (6, f"{passage} copy\nz")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.text for r in line_templates.dedup(docs).collect()}
    assert out == dict(rows) | {2: "another text"}  # copies of one document are not two texts


def test_lines_of_documents_without_an_id(spark):
    rows = [(1, "common line here\na"), (2, "common line here\nb"), (None, "common line here\nc"), (None, "unique line\nd"), (None, "e\ncommon line here"), (7, "f\ncommon line here"), (7, "other\ng")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = Counter(tuple(r) for r in line_templates.dedup(docs).collect())
    assert out == Counter([rows[0], (2, "b"), (None, "c"), rows[3], (None, "e"), (7, "f"), rows[6]])
    alone = spark.createDataFrame([(None, f"common line here\n{x}") for x in "abc"], "doc_id long, text string")
    assert sum("common" in r.text for r in line_templates.dedup(alone).collect()) == 1


# --- verified near copies


def test_similar_roots():
    rng = random.Random(5)
    sets = []
    for _ in range(30):
        own = set(rng.sample(range(400), rng.randint(1, 60)))
        for _ in range(12):
            sets.append(frozenset(own))
            own = {x if rng.random() < 0.95 else rng.randrange(400) for x in own}
    sets = list(dict.fromkeys([*sets, frozenset()]))
    root = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if sets[i] | sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) and root[i] != root[j]:
                a, b = sorted((root[i], root[j]))
                root = [a if x == b else x for x in root]
    assert simhash.similar_roots([np.array(sorted(x), np.uint64) for x in sets]) == root
    assert 30 < len(set(root)) < len(sets)


def test_near_copies_are_verified(spark):
    """Texts whose fingerprints are near but that share under 0.8 of their shingles stay; chains end where a link is below it."""
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join(base), " ".join(base[:150] + [f"v{i}" for i in range(50)]), " ".join(base[:-2] + ["x"]), " ".join(base[:170] + [f"y{i}" for i in range(10)])]
    own = [shingles(t) for t in texts]
    like = lambda i, j: len(own[i] & own[j]) / len(own[i] | own[j])
    assert 0.5 < like(0, 1) < 0.8 < like(0, 2)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    root = {r.doc_id: r.component_id for r in simhash.near_components(df, threshold=60, reach=6).collect()}
    assert (root[1], root[2]) == (1, 0)
    assert root[3] == (0 if max(like(3, 0), like(3, 2)) >= 0.8 else 3)


def test_near_dedup_without_ids(spark):
    words = lambda s: " ".join(f"{s}{i}" for i in range(40))
    rows = [(None, words("a")), (None, words("b")), (None, words("b")), (None, words("c")), (3, words("c")), (7, words("d")), (7, words("e")), (7, words("e")), (None, None), (None, "")]
    out = Counter((r.doc_id, r.text or "") for r in simhash.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert out == Counter([rows[0], rows[1], rows[4], rows[5], rows[6], (None, "")])


@pytest.mark.parametrize(("before", "value", "after"), [('token = "', "k3Y-" * 90, '" end'), ("secret: '", "k3Y," * 90, "' end"), ("api_key=", "eyJh.bGc_" * 60, " end"), ("account no. ", "1234 5678 " * 6 + "12", " end")])
def test_long_secrets_and_accounts(before, value, after):
    found = [s for s in pii.spans(before + value + after, pii.automaton()) if s[0] in ("secret", "account")]
    assert [s[1:] for s in found] == [(len(before), len(before) + len(value))]
