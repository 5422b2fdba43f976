"""The text operators against brute force, on small tables with the awkward rows."""

import base64
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from tributary.llm import bpe, chat, fingerprints, licences, near, packing, quality, sharding, substring
from tributary.llm.components import components


def corpus():
    r = random.Random(1)
    words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(1, 7))) for _ in range(300)]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    passage, hot = text(60), text(150).split(" ")
    docs = [(d, text(r.randint(1, 200))) for d in range(0, 60)]
    docs += [(100 + d, f"{text(30)} {passage}\n{text(20)}") for d in range(20)]
    for d in range(40):  # near copies of one text, a few words changed each
        own = list(hot)
        for _ in range(d % 8):
            own[r.randrange(len(own))] = r.choice(words)
        docs.append((200 + d, " ".join(own)))
    docs += [(300 + d, docs[3][1]) for d in range(10)]  # exact copies
    docs += [(400, None), (401, ""), (402, " \t\n "), (403, "one two"), (404, "ONE two"), (405, "Ünïcödé 中文 ½ 🙂  x\u0085y"),
             (406, text(3_000)), (406, text(30)), (5, docs[5][1]), (407, "a" * 5_000)]
    return docs


DOCS = corpus()


@pytest.fixture(scope="module")
def docs(spark):
    """The corpus with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(d, t, "x", 1) for d, t in DOCS], "doc_id long, text string, k string, size int").repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def by_row(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


def test_bpe_equals_the_library(spark, docs, none):
    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    codec = bpe.broadcast_codec(spark, path, public_tokenizers.PATTERN)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = by_row(bpe.decode(bpe.encode(docs, codec), codec), "doc_id", "ids", "decoded")
    want = Counter((d, np.array(own.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for d, t in DOCS)
    assert {(a, bytes(b), bytes(c)): n for (a, b, c), n in got.items()} == want
    assert bpe.encode(none, codec).count() == 0
    index = bpe.MinimalPerfectHash(list(ranks))
    assert sorted(index.slot(k) for k in ranks) == list(range(len(ranks)))


def test_packing(spark, docs, none):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    file = Tokenizer.from_file(path)
    file.encode_special_tokens = True
    encoder = packing.broadcast_encoder(spark, path)
    rows = packing.pack_documents(docs, encoder, capacity=256).collect()
    want = Counter()
    for d, t in DOCS:
        ids = np.array([*file.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        at = k = 0
        while at < len(ids):
            n = (len(ids) - 1) % 256 + 1 if k == 0 else 256
            want[d, k, at, n, zlib.crc32(ids[at:at + n].tobytes())] += 1
            at, k = at + n, k + 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    held = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in held.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= 256
    bins = []  # no more sequences than first-fit decreasing needs
    for n in sorted((r.length for r in rows), reverse=True):
        for i, room in enumerate(bins):
            if room >= n:
                bins[i] -= n
                break
        else:
            bins.append(256 - n)
    assert len(held) <= len(bins)
    assert packing.pack_documents(none, encoder).count() == 0
    assert packing.fullest(Counter({5: 2, 3: 1, 4: 3}), 12) in ([4, 4, 4], [5, 4, 3], [3, 4, 5], [4, 3, 5], [5, 3, 4], [3, 5, 4], [4, 5, 3])


def test_substrings(docs, none):
    seen, want = set(), Counter()
    unique = {}
    for d, t in sorted(DOCS, key=lambda x: x[0]):
        unique.setdefault((d, t), 0)
        unique[d, t] += 1
    first = {}
    for d, t in unique:
        w = (t or "").encode().split()
        for i in range(len(w) - 19):
            key = tuple(w[i:i + 20])
            first[key] = min(first.get(key, (d, i)), (d, i))
    for (d, t), n in unique.items():
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for i in range(len(w) - 19):
            if first[tuple(w[i:i + 20])] != (d, i):
                gone[i:i + 20] = [True] * 20
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        want[d, len(w), sum(gone), hashlib.sha256(kept).hexdigest()] += n
    assert by_row(substring.removal_digests(docs), "doc_id", "n_words", "n_removed", "kept_sha256") == want
    left = substring.without_repeats(docs)
    assert left.columns == docs.columns and left.where("text is null").count() == 1
    assert substring.removal_digests(none).count() == 0
    assert {(a - b) % substring.PERIOD for a in substring.COVER for b in substring.COVER} == set(range(substring.PERIOD))


def near_brute(words, over, under):
    def shingles(t):
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").encode().split()
        return frozenset(tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))) if w else frozenset()

    own = {}
    for d, t in DOCS:
        own.setdefault(shingles(t), set()).add(d)
    root = {d: d for d, _ in DOCS}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    def link(a, b):
        a, b = sorted((find(a), find(b)))
        root[b] = a

    sets = [(s, ids) for s, ids in own.items() if s]
    for i, (s, ids) in enumerate(sets):
        for d in ids:
            link(min(ids), d)
        for s2, ids2 in sets[:i]:
            both = len(s & s2)
            if under * both >= over * (len(s) + len(s2) - both):
                link(min(ids), min(ids2))
    return Counter((d, len(shingles(t)), find(d)) for d, t in DOCS)


def test_near_duplicates(docs, none):
    got = by_row(near.near_components(docs, shingle_words=3, threshold=(85, 100)), "doc_id", "n_shingles", "component_id")
    assert got == near_brute(3, 85, 100)
    assert near.near_components(none).count() == 0


def test_fingerprints(docs, none):
    rows = fingerprints.edited_fingerprints(docs).collect()
    assert len(rows) == len(DOCS)
    assert len({r.fingerprint for r in rows if r.doc_id in range(300, 310)}) == 1
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    unique = {d: t or "" for d, t in DOCS if sum(x == d for x, _ in DOCS) == 1}
    order = sorted(unique, reverse=True)
    for a, b in zip(order, order[1:]):
        if a != 407 and b in (a - 1,):
            want = hashlib.sha256(fingerprints.edit(unique[a], unique[b]).encode()).hexdigest()
            assert [r.edited_sha256 for r in rows if r.doc_id == a] == [want]
    assert fingerprints.edited_fingerprints(none).count() == 0
    classes = {r.doc_id: r.class_id for r in fingerprints.near_links(docs).collect()}
    assert all(classes[d] == classes[3] for d in range(300, 310))


def test_sharding(docs, none):
    rows = sharding.assign_shards(docs, 4).collect()
    assert Counter((r.doc_id, r.size) for r in rows) == Counter((d, len((t or "").encode()) + 1) for d, t in DOCS)
    for shard in range(4):
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
    sizes = Counter()
    for r in rows:
        sizes[r.shard] += r.size
    assert max(sizes.values()) - min(sizes.values()) <= 2 * max(r.size for r in rows)
    assert sharding.assign_shards(none, 4).count() == 0
    checksums = Counter((r.doc_id, r.text_crc32) for r in rows)
    assert checksums == Counter((d, zlib.crc32((t or "").encode())) for d, t in DOCS)
    homes = {}  # equal texts share a shard, unless they fill one
    for r in rows:
        homes.setdefault((r.size, r.text_crc32), set()).add(r.shard)
    assert all(len(h) == 1 for h in homes.values())


def test_sharding_splits_along_sources_with_a_long_common_beginning(spark):
    docs = spark.createDataFrame([(d, f"text number {d:04d}", f"https://example.org/{'ab'[d % 2]}") for d in range(200)],
                                 "doc_id long, text string, source string")
    rows = sharding.assign_shards(docs, 2).collect()
    assert Counter((r.doc_id % 2, r.shard) for r in rows).values() and len({(r.doc_id % 2, r.shard) for r in rows}) == 2
    assert Counter(r.shard for r in rows) == Counter({0: 100, 1: 100})


def test_quality_statistics_and_model(spark, docs, none):
    junk = " ".join(f"w{i}###" for i in range(80))
    labelled = spark.createDataFrame([(1_000 + i, (junk if i % 2 else DOCS[i][1] * 2) + f" n{i}") for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(1_000 + i, 1 - i % 2) for i in range(60)], "doc_id long, quality int")
    model = quality.train(labelled, labels)
    assert quality.train(labelled, labels.where("quality = 1")) is None
    got = quality.judge(docs, model).collect()
    assert len(got) == len(DOCS) and quality.judge(none, None).count() == 0
    t = "a b c a b c\nx\nx\n \n"
    assert quality.statistics(t, t.encode().split()) == (8, 8, 0, 1, 6)
    bad = quality.judge(spark.createDataFrame([(1, junk + " tail")], "doc_id long, text string"), model).first()
    assert not bad.base_failed and not bad.kept
    assert quality.keep_good(docs, None).columns == docs.columns


def test_chat_round_trip(spark):
    rows = [(1, 0, "user", "a & b < c > [x] ]\n</s>\n<s>[user]\n"), (1, 1, "assistant", "&amp; &lt;image:0&gt;"), (1, 2, None, None),
            (1, 2, "assistant", ""), (2, 0, "assistant", "x" * 100_000), (None, 0, "user", "n")]
    told = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.conversation_digests(told).collect()}
    assert set(got) == {1, 2, None, -1}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    order = sorted((x for x in rows if x[0] == 1), key=lambda x: (x[1], x[2] or ""))
    assert got[1].turns_sha256 == sha("".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in order))
    assert got[1].loss_sha256 == sha("&amp; &lt;image:0&gt;") and got[2].loss_chars == 100_000
    parts = spark.sql("""select 1L conv_id, 0L turn, 'user' role, array(
        named_struct('type','text','text','see','ref',string(null),'width',int(null),'height',int(null),'seconds',double(null),'pages',int(null)),
        named_struct('type','image','text',string(null),'ref','a.png','width',56,'height',29,'seconds',double(null),'pages',int(null))) parts""")
    made = chat.format_conversations(parts).first()
    assert made.formatted == "<s>[user]\nsee<image:0></s>\n" and [(a.ref, a.tokens) for a in made.attachments] == [("a.png", 4)]


def test_licences(spark, none):
    rows = [(1, "some prose here\nReleased under the MIT License."), (2, "Licensed under the Apache License, Version 2.0."), (3, None), (4, ""),
            (5, "She lost her driving license.")]
    got = licences.scan(spark.createDataFrame(rows, "doc_id long, text string"), licences.train(["a plain line of words"] * 50)).collect()
    assert {(r.doc_id, r.paragraph, r.license, r.confirmed) for r in got} == {(1, 1, "mit", True), (2, 0, "apache-2.0", True)}
    assert licences.scan(none, licences.train(["plain"])).count() == 0


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 50), (7, 7), (200, 200), (None, 3)], "a long, b long")
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 50, 50: 50, 200: 200}
