"""URL filter, Merkle manifest and collocations against brute force, with odd rows."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from entiva.llm import merkle, phrases, url_filter
from entiva.llm.queries import UNWANTED_WORDS, URL_RULES

CLASHES = ("key", "keys", "on", "first", "second", "place", "node", "tree", "n", "words", "task")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def clashing(frame):
    return frame.select("*", *[F.lit("x").alias(c) for c in CLASHES if c not in frame.columns])


# URLs


def parts_of(url):
    found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return (lower(found[1]), found[2]) if found else ("", "")


def judged(url, rules, unwanted):
    host, path = parts_of(url)

    def fits(key):
        rule_host, slash, rest = key.partition("/")
        return (host == rule_host or host.endswith("." + rule_host)) and path.startswith(
            slash + rest
        )

    own = [(len(k), k) for k, _ in rules if host and fits(k)]
    listed = bool(host) and any(fits(k) for k in unwanted)
    rule = max(own)[1] if own else None
    blocks = ((rule, "block") in rules) if own else listed
    return host, path, rule, "block" if blocks else "allow", listed


ODD_URLS = [
    None, "", "no scheme", "://", "http://", "http:///only/path", "HTTP://WWW.Example.ORG/en/1x",
    "https://a.example.org?x=/en/1", "http://org", "http://org/", "http://xorg/", "http://.org/",
    "http://example.org:80/en/1", "x://y://example.com/de/", "http://example.com/de", "a://com/fr/é",
    "http://example.com/DE/", "http://a.casino-x.example.net/fr/", "http://casino/", "ü://ü.org/ü#/",
    "http://two\nlines.org/\n?", "http://" + "a." * 20_000 + "org/" + "b/" * 20_000,
    "http://example.org/es/", "http://example.org/es/",
]


def test_urls_equal_brute_force(spark):
    urls = ODD_URLS + [
        f"http://{h}{p}"
        for h in ("a.b.net", "b.net", "net", "B.NET", "casino-a.b.net", "c.com", "org")
        for p in ("", "/", "/de/x", "/fr/x", "/es", "?q", "/fr/#f")
    ]
    rows = clashing(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"))
    unwanted = ["b.net", "c.com/es", "Casino-X.example.net", "never.seen", "", None]
    frame = spark.createDataFrame([(k,) for k in unwanted], "key string")
    rules = spark.createDataFrame(URL_RULES, "key string, verdict string")
    listed = [k.lower() for k in unwanted if k]
    for keys_per_shard, part_bytes in ((1 << 18, 1 << 26), (5, 400)):
        found = url_filter.judge(
            rows, rules, frame, keys_per_shard=keys_per_shard, part_bytes=part_bytes
        ).collect()
        assert len(found) == len(urls)
        for row in found:
            assert tuple(row)[1:] == judged(urls[row.page_id], URL_RULES, listed), urls[row.page_id]


def test_urls_without_lists_or_rows(spark):
    rules = spark.createDataFrame([], "key string, verdict string")
    none = spark.createDataFrame([], "key string")
    rows = spark.createDataFrame([(1, "http://a.org/"), (1, None)], "page_id long, url string")
    found = url_filter.judge(rows, rules, none).collect()
    assert [(r.rule, r.verdict) for r in found] == [(None, "allow")] * 2
    assert url_filter.judge(rows.limit(0), rules, none).collect() == []
    both = spark.createDataFrame([("org/", "allow"), ("org/", "block")], "key string, verdict string")
    assert {r.verdict for r in url_filter.judge(rows, both, none).collect()} == {"block", "allow"}


def test_cascade_is_exact_and_small():
    chance = np.random.default_rng(3)
    keys = chance.integers(0, 2**64, (60_000, 2), dtype=np.uint64)
    for listed in (0, 1, 3, 700, 59_999, 60_000):
        levels = url_filter.build_levels(keys[:listed], keys[listed:])
        part = url_filter.Part(1, 0, 1, {1: {0: levels}})
        if not listed:
            assert not levels
            continue
        shard = np.zeros(len(keys), np.int64)
        found = url_filter.listed_in(part.arranged()[1], shard, keys[:, 0], keys[:, 1])
        assert found[:listed].all() and not found[listed:].any()
        if listed == 700:
            # 86 others for one listed key: some bits a key, where a set of hashes takes 128
            assert sum(len(level.data) for level in levels) * 8 < 16 * listed
    with pytest.raises(ValueError):
        url_filter.build_levels(keys[:1], keys[:1])


def test_unwanted_domains(spark):
    hosts = ["m.casino-win.a.com", "casino.com", "x.ads.b.c", "casinos.com", "a.com", "b.casino", ""]
    rows = spark.createDataFrame([(f"http://{h}/",) for h in hosts] + [(None,)], "url string")
    found = {r.key for r in url_filter.domains_with(rows, "url", UNWANTED_WORDS).collect()}
    assert found == {"casino-win.a.com", "casino.com", "ads.b.c"}


# Manifest


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def written(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(nodes, fanout):
    """The root, and for every leaf the siblings before and after it, level by level."""
    steps, below = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, held = [], []
        for at in range(0, len(nodes), fanout):
            run = nodes[at : at + fanout]
            for j in range(len(run)):
                for i in below[at + j]:
                    steps[i].append(("".join(run[:j]), "".join(run[j + 1 :])))
            up.append(digest(*run))
            held.append([i for j in range(len(run)) for i in below[at + j]])
        nodes, below = up, held
    return nodes[0], steps


def expected_manifest(rows, fanout):
    groups = collections.defaultdict(list)
    for doc_id, text, lang, source, chars in rows:
        own = digest(*map(written, (doc_id, source, lang, chars, text)))
        other = None if text is None else lower(text)
        changed = zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 5 == 0
        start = digest(*map(written, (doc_id, source, lang, chars, other))) if changed else own
        groups[source].append(((doc_id is not None, doc_id or 0), own, doc_id, start))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort()
        trees[name] = tree([g[1] for g in groups[name]], fanout)
    root, upper = tree([trees[name][0] for name in names], fanout)
    found = []
    for name, above in zip(names, upper):
        for (_, own, doc_id, node), steps in zip(groups[name], trees[name][1]):
            steps = steps + above
            for before, after in steps:
                node = digest(before, node, after)
            proof = digest(*[b + a for b, a in steps])
            found.append((doc_id, own, trees[name][0], root, proof, node, node == root))
    return sorted(found, key=repr)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("fanout", [16, 3])
def test_manifest_equals_brute_force(spark, fanout):
    chance = random.Random(5)
    sizes = {"one": 1, "full": 16, "over": 17, "many": 300, "É": 2, "": 5, None: 33, "a": 3}
    rows, number = [], 0
    for source, size in sizes.items():
        for _ in range(size):
            number += 1
            text = chance.choice([None, "", "Ab", "é\nB", "plain text", "X" * 3000])
            lang = chance.choice([None, "en"])
            rows.append((number, text, lang, source, chance.choice([None, 7, -1])))
    rows += [(None, "A", "en", "many", 1), (None, "B", "en", "many", 1)]
    rows += [(77, "Same", "en", "full", 4)] * 40
    chance.shuffle(rows)
    frame = clashing(spark.createDataFrame(rows, DOCUMENT)).repartition(5)
    found = merkle.manifest(frame, fanout=fanout, tampered=merkle.every_fifth())
    found = found.select(*COLUMNS).collect()
    assert sorted(map(tuple, found), key=repr) == expected_manifest(rows, fanout)
    assert {r.verified for r in found} == {True, False}


@pytest.mark.parametrize("rows", [
    [], [(1, "A", "en", None, 1)], [(i, "t", "en", "s", 1) for i in range(17)],
    [(i, "t", "en", f"s{i}", 1) for i in range(20)], [(5, "x", None, "s", 1)] * 20,
])
def test_manifest_of_few_rows(spark, rows):
    found = merkle.manifest(spark.createDataFrame(rows, DOCUMENT), tampered=merkle.every_fifth())
    found = [tuple(r) for r in found.select(*COLUMNS).collect()]
    assert sorted(found, key=repr) == (expected_manifest(rows, 16) if rows else [])


def test_manifest_spreads_one_group(spark):
    rows = spark.range(40_000).selectExpr(
        "id as doc_id", "'t' as text", "'en' as lang", "'s' as source", "1L as n_chars"
    )
    workspace = merkle.Workspace(spark)
    found = merkle.manifest(rows, workspace=workspace)
    assert found.filter("verified").count() == 40_000
    starts = spark.read.parquet(workspace.folder("rows-starts"))
    assert starts.count() > 1 and starts.select("members").distinct().collect() == [(40_000,)]


# Collocations


def counted(rows, least, most):
    counts, totals = collections.defaultdict(collections.Counter), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower(text)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, 5):
                    if i + k <= len(words):
                        counts[lang][tuple(words[i : i + k])] += 1
    found = []
    for lang, c in counts.items():
        candidates = {
            g: min(
                (2_000_000 * a // (c[g[:k]] + c[g[k:]]), k, c[g[:k]], c[g[k:]])
                for k in range(1, len(g))
            )
            for g, a in c.items()
            if len(g) > 1 and a >= least
        }
        covered = {
            g[b : b + size]
            for g in candidates
            for size in range(2, len(g))
            for b in range(len(g) - size + 1)
            if 100 * c[g] >= 80 * c[g[b : b + size]]
        }
        best = sorted(
            (-v[0], -c[g], " ".join(g).encode(), v[2], v[3])
            for g, v in candidates.items()
            if g not in covered
        )
        for rank, (score, a, phrase, left, right) in enumerate(best[:most], 1):
            found.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(found)


@pytest.fixture(scope="module")
def texts():
    chance = random.Random(9)
    words = ["The", "of", "a", "é", "x-y", "(b)", "long" * 40, "\xa0"]
    rows = [
        (
            "".join(
                chance.choices(words, [5, 4, 3, 2, 1, 1, 1, 1])[0]
                + chance.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n"])
                for _ in range(chance.randint(0, 200))
            ),
            chance.choice(["en", "de", None, ""]),
        )
        for _ in range(60)
    ]
    return rows + [(None, "en"), ("", None), (" .,; \t", "fr"), ("und so weiter", "und")] + [rows[0]] * 30


@pytest.mark.parametrize("modulus", [1, 2, 8, 10_000])
def test_collocations_equal_brute_force(spark, texts, modulus):
    frame = clashing(spark.createDataFrame(texts, "text string, lang string")).repartition(3)
    for least, most in ((2, 2000), (30, 7)):
        found = phrases.collocations(frame, least=least, most=most, modulus=modulus)
        assert sorted(map(tuple, found.collect())) == counted(texts, least, most)


def test_parse_is_prefix_free_and_whole(spark, texts):
    frame = spark.createDataFrame(texts, "text string, lang string")
    parse = phrases.chunks(frame, "text", "lang", 3).collect()
    assert sum(r.own for r in parse) == sum(
        len(re.findall("[^ \t.,;:!?\n\x0b\x0c\r]+", text or "")) for text, _ in texts
    )
    assert sum(r.last for r in parse) == sum(bool(text and text.strip(" .,;\t")) for text, _ in texts)
    chunks = {r.chunk for r in parse if not r.last}
    assert len(chunks) > 50
    starts = [(a, b) for a in chunks for b in chunks if a != b and b.startswith(a)]
    assert not [(a, b) for a, b in starts if b[len(a)] in " \n"]


def test_more_marks_than_frequent_words_change_nothing(spark, texts, monkeypatch):
    """Several shards, and a table with every bit set."""
    frame = spark.createDataFrame(texts, "text string, lang string")
    monkeypatch.setattr(phrases, "KEYS_PER_SHARD", 500)
    found = phrases.collocations(frame, least=5)
    assert sorted(map(tuple, found.collect())) == counted(texts, 5, 2000)
    monkeypatch.setattr(phrases, "mark_table", lambda *_: (16, np.full(1 << 13, 255, np.uint8)))
    found = phrases.collocations(frame, least=5)
    assert sorted(map(tuple, found.collect())) == counted(texts, 5, 2000)


def test_collocations_of_one_long_piece_and_none(spark):
    long_text = " ".join(f"w{i % 7}" for i in range(150_000)) + " same" * 100_000
    rows = [(long_text, "en")]
    frame = spark.createDataFrame(rows, "text string, lang string")
    found = phrases.collocations(frame).collect()
    assert sorted(map(tuple, found)) == counted(rows, 30, 2000)
    assert phrases.collocations(frame.limit(0)).collect() == []


def test_blocks_and_slices_change_nothing(texts, monkeypatch):
    own = [(text or "").encode() for text, _ in texts]
    words = phrases.Words(own)
    begin, sizes = np.arange(len(words) - 3), np.full(len(words) - 3, 3)
    hashes, joined = words.hashes(phrases._FIRST), words.joined(begin, sizes)
    monkeypatch.setattr(phrases, "SLICE_BYTES", 7)
    assert (words.hashes(phrases._FIRST) == hashes).all()
    assert words.joined(begin, sizes) == joined
    monkeypatch.setattr(phrases, "BLOCK_BYTES", 300)
    blocks = [phrases.Words(own[part]) for part in phrases._blocks(own)]
    assert len(blocks) > 5
    assert (np.concatenate([b.hashes(phrases._FIRST) for b in blocks]) == hashes).all()
    starts = [b.data[b.starts] for b in blocks]
    assert (np.concatenate(starts) == words.data[words.starts]).all()


def test_scores_beyond_64_bits(spark):
    big = 2**62
    counts = spark.createDataFrame(
        [("en", "a", 1, big), ("en", "b", 1, big), ("en", "a b", 2, big - 1)],
        "lang string, phrase string, words int, f long",
    )
    found = phrases.weakest_cuts(counts).first()
    assert found.score == 2_000_000 * (big - 1) // (2 * big) == 999_999
