"""The corpus operators against brute-force versions, on tables with odd rows."""

from __future__ import annotations

import itertools
import math
import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tablegate.llm import (
    components,
    decontaminate,
    language,
    lines,
    links,
    mixing,
    ngram,
    quality,
    queries,
    runs,
    simhash,
    substrings,
    tokens,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, words string, row int"
WORDS = [f"w{i}" for i in range(300)]


def prose(rng: random.Random, n: int, per_line: int = 12) -> str:
    words = [rng.choice(WORDS) for _ in range(n)]
    return "\n".join(" ".join(words[i : i + per_line]) for i in range(0, n, per_line))


@pytest.fixture(scope="module")
def rows():
    """Copies, near copies, nulls, empty and long texts, repeated rows, clashing columns."""
    rng = random.Random(7)
    texts = [prose(rng, rng.randint(1, 160)) for _ in range(40)]
    texts += [texts[3], texts[3], texts[4].replace("w1", "w299", 1), texts[5] + " tail"]
    for i in range(12):
        words = texts[6].split(" ")
        words[i % len(words)] = "changed"
        texts.append(" ".join(words))
    texts += [None, "", " \n\t ", "\n\n", "a a a a a a", "#* x $%", prose(rng, 6000), "Ünïcode ▁ und  ß\r\nzwei"]
    made = [(i, t, ("en", "de", None)[i % 3], ("s0", "s1", None)[i % 3]) for i, t in enumerate(texts)]
    made += [made[3], (made[7][0], "another text of the same id", "en", "s0"), (None, texts[8], "de", "s1")]
    return made


@pytest.fixture(scope="module")
def docs(spark, rows):
    full = [(*r, None if r[1] is None else len(r[1]), "clash", 1) for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return (text or "").encode().lower().split()


def test_runs_give_every_pair(spark):
    rng = random.Random(1)
    data = [(rng.choice([1, 2, 3, 3, 3, 3]), i) for i in range(400)]
    table = spark.createDataFrame(data, "key long, item long")
    pairs = []
    for block in (1000, 16):
        units = runs.in_units(table, block)
        found = runs.spanning_pairs(units, "item", lambda c, x, y: np.ones(len(x), bool))
        grouped = components.components(found.distinct())
        pairs.append({r["node"]: r["component"] for r in grouped.collect()})
    smallest = {}
    for key, item in data:
        smallest[key] = min(item, smallest.get(key, item))
    expected = {item: smallest[key] for key, item in data}
    assert pairs[0] == pairs[1] == expected


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(50, 40)], "a long, b long")
    found = {r["node"]: r["component"] for r in components.components(edges).collect()}
    assert found == {**{i: 0 for i in range(31)}, 40: 40, 50: 40}


def test_quality_counts(docs, rows, empty):
    got = Counter(
        (r["row"]["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
        for r in quality.quality(docs).collect()
    )
    expected = Counter()
    for doc, text, _, _ in rows:
        own = [w.decode() for w in (text or "").encode().split()]
        lines_ = [x for x in (text or "").split("\n") if x.encode().split()]
        windows = defaultdict(list)
        for i in range(len(own) - 2):
            windows[tuple(own[i : i + 3])].append(i)
        covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
        failed = len(own) < 50 or 100 * len(covered) > 50 * len(own)
        expected[
            (doc, len(own), sum(map(len, own)), sum((text or "").count(c) for c in "#*$%&|<>"),
             len(lines_) - len(set(lines_)), len(covered), failed)
        ] += 1
    assert got == expected
    assert quality.quality(empty).count() == 0


def test_quality_removes_lines_and_rejects(spark):
    rng = random.Random(2)
    data = [(i, prose(rng, 60) + ("\n Shared BOILER line " if i % 2 else ""), "h", 1) for i in range(60)]
    data.append((100, "\n".join(["shared boiler line"] * 10 + [prose(rng, 20, 30)]) + " x" * 30, "h", 1))
    data.append((101, "\n".join(f"shared boiler line" for _ in range(30)) + "\none two three", "h", 1))
    table = spark.createDataFrame(data, "doc_id long, text string, source string, n_chars long")
    result = {r["row"]["doc_id"]: r for r in quality.quality(table).collect()}
    assert result[1]["lines_removed"] == 1 and result[0]["lines_removed"] == 0
    assert "BOILER" not in result[1]["clean_text"] and result[1]["kept"]
    assert result[100]["lines_removed"] == 10 and not result[101]["kept"]
    passed = {r["doc_id"]: r for r in quality.passing(table).collect()}
    assert passed[1]["n_chars"] == len(passed[1]["text"]) and passed[0]["n_chars"] == 1


def brute_lines(rows, threshold=Fraction(4, 5)):
    found = []
    for at, (doc, text, *_) in enumerate(rows):
        for number, line in enumerate(lines.lines_of(text)):
            if line.split():
                found.append((-1 if doc is None else doc, number, at, frozenset(line.split())))
    gone = defaultdict(set)
    for d, n, at, x in found:
        for d2, n2, at2, y in found:
            if (d2, n2) < (d, n) and len(x & y) * threshold.denominator >= len(x | y) * threshold.numerator:
                gone[at].add(n)
    return gone


@pytest.mark.parametrize("block", [2048, 4])
def test_line_dedup(docs, rows, monkeypatch, block):
    monkeypatch.setattr(lines, "BLOCK_ROWS", block)
    monkeypatch.setattr(lines, "FREQUENT", 64)
    gone = brute_lines(rows)
    expected = Counter()
    for at, (doc, text, *_) in enumerate(rows):
        kept = text
        if text is not None:
            kept = "\n".join(x for n, x in enumerate(text.split("\n")) if n not in gone[at])
        expected[(doc, kept, tuple(sorted(gone[at])))] += 1
    got = Counter(
        (r["row"]["doc_id"], r["clean_text"], tuple(r["removed"])) for r in lines.dedup_lines(docs).collect()
    )
    assert got == expected
    assert sum(map(len, gone.values())) > 20


def test_line_dedup_of_nothing_and_of_wide_lines(spark, empty):
    assert lines.dedup_lines(empty).count() == 0
    rng = random.Random(3)
    data = []
    for i in range(30):
        base = [f"x{rng.randrange(100000)}" for _ in range(rng.choice([90, 200, 500, 2000]))]
        data.append((2 * i, " ".join(base)))
        for j in range(len(base) * rng.randint(2, 14) // 100):
            base[j] = f"y{rng.randrange(100000)}"
        data.append((2 * i + 1, " ".join(base)))
    table = spark.createDataFrame(data, "doc_id long, text string")
    gone = brute_lines(data)
    got = {r["row"]["doc_id"]: set(r["removed"]) for r in lines.dedup_lines(table).collect()}
    assert got == {i: gone[i] for i in range(60)}
    assert 0 < sum(map(len, gone.values())) < 30


def brute_print(text):
    own = words(text)
    shingles = [b" ".join(own[i : i + 3]) for i in range(max(1, len(own) - 2))] if own else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(docs, rows, empty):
    prints = [brute_print(r[1]) for r in rows]
    root = list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= 3:
                    root[i] = min(root[i], root[j])
    ids = defaultdict(list)
    for i, r in enumerate(root):
        if rows[i][0] is not None:
            ids[r].append(rows[i][0])
    expected = Counter((rows[i][0], f"{prints[i]:016x}", min(ids[root[i]])) for i in range(len(rows)))
    got = Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(docs).collect())
    assert got == expected
    kept = simhash.keep_one(docs).collect()
    assert len(kept) == len(set(root)) and sorted(kept[0].asDict()) == sorted(docs.columns)
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0


def test_simhash_links_random_neighbours(spark):
    rng = random.Random(5)
    prints = [rng.getrandbits(64) for _ in range(300)]
    for p in prints[:100]:
        for bits in range(5):
            prints.append(p ^ sum(1 << b for b in rng.sample(range(64), bits)))
    prints = sorted(set(prints))
    signed = [simhash._signed(p) for p in prints]
    table = spark.createDataFrame([(s,) for s in signed], "fingerprint long")
    found = {r["node"]: r["component"] for r in components.components(simhash.links(table)).collect()}
    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 3:
                assert found[signed[i]] == found[signed[j]]
    groups = defaultdict(list)
    for s, p in zip(signed, prints):
        groups[found.get(s, s)].append(p)
    for group in groups.values():
        reached, todo = set(), [group[0]]
        while todo:
            x = todo.pop()
            reached.add(x)
            todo += [y for y in group if y not in reached and (x ^ y).bit_count() <= 3]
        assert reached == set(group)


def test_decontamination(spark, docs, empty):
    rng = random.Random(11)
    items = [(i, prose(rng, n, 50)) for i, n in enumerate((40, 25, 16, 8, 3))] + [(9, None), (0, prose(rng, 20, 50))]
    noisy = items[0][1].split()
    for i in (3, 9, 17, 25, 33):
        noisy[i] = "other"
    data = [
        (1, prose(rng, 50) + " " + items[0][1].upper() + "! " + prose(rng, 20)),
        (2, prose(rng, 9) + "\n" + " ".join(noisy)),
        (3, "x " + items[3][1] + " y"),
        (4, prose(rng, 300)),
        (5, items[4][1]),
        (6, None),
        (7, " ".join(items[1][1].split()[:14])),
        (None, items[2][1]),
        (8, ""),
    ]
    table = spark.createDataFrame(data + [data[0]], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(table, bench).collect()}
    assert found == {(1, 0), (2, 0), (3, 3), (7, 1), (None, 2)}
    left = decontaminate.decontaminate(table, bench).collect()
    assert sorted(r["doc_id"] for r in left) == [4, 5, 6, 8]
    assert decontaminate.contaminated(empty, bench).count() == 0
    assert decontaminate.decontaminate(table, bench.filter("false")).count() == 10


def test_every_verified_pattern_is_found(spark):
    items, data, expected = [], [], set()
    for length in range(5, 17):
        own = [f"i{length}x{i}" for i in range(length)]
        items.append((length, " ".join(own)))
        for k in range(4):
            for bad in itertools.combinations(range(length), k):
                changed = ["other" if i in bad else w for i, w in enumerate(own)]
                window = min(decontaminate.WINDOW, length)
                best = max(
                    sum(j not in bad for j in range(i, i + window)) for i in range(length - window + 1)
                )
                doc = len(data)
                # Bare, so that changed ends are also the ends of the text, or inside a text.
                data.append((doc, " ".join(changed if doc % 2 else ["a", "b", *changed, "c"])))
                if best * 100 >= window * decontaminate.MIN_PERCENT:
                    expected.add((doc, length, best))
        for cut in range(1, 4):
            kept = own[cut:] if cut % 2 else own[:-cut]
            window = min(decontaminate.WINDOW, length)
            data.append((len(data), " ".join(kept)))
            best = min(window, length - cut)
            if best * 100 >= window * decontaminate.MIN_PERCENT:
                expected.add((len(data) - 1, length, best))
    table = spark.createDataFrame(data, "doc_id long, text string").coalesce(2)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["best_window"]) for r in decontaminate.contaminated(table, bench).collect()}
    assert got == expected


def test_raking_reaches_the_marginals(docs, empty):
    rows = mixing.calibrated(docs).collect()
    assert len(rows) == docs.count() and all(0 <= r["probability"] <= 1 for r in rows)
    total = sum(r["n_tokens"] for r in rows)
    for dim in ("source", "lang"):
        natural, raked = Counter(), Counter()
        for r in rows:
            natural[r[dim]] += r["n_tokens"]
            raked[r[dim]] += r["n_tokens"] * r["rate"] / total
        parts = {k: v**mixing.POWER for k, v in natural.items()}
        for k, part in parts.items():
            assert math.isclose(raked[k], part / sum(parts.values()), rel_tol=1e-3)
    assert max(r["probability"] for r in rows) == 1.0
    assert mixing.calibrated(empty).count() == 0
    assert sorted(mixing.sampled(docs).columns) == sorted(docs.columns)


def test_substrings(docs, rows, empty):
    first, expected = {}, Counter()
    every = []
    for doc, text, *_ in rows:
        begin = 0
        for number, line in enumerate([] if text is None else text.split("\n")):
            own = tuple(words(line))
            if len(own) >= substrings.MIN_WORDS:
                rank = (-1 if doc is None else doc, number)
                first[own] = min(first.get(own, rank), rank)
                every.append((doc, number, begin, begin + len(line), own, rank))
            begin += len(line) + 1
    for doc, number, begin, end, own, rank in every:
        if rank > first[own]:
            at = first[own]
            expected[(doc, number, begin, end, len(own), None if at[0] < 0 else at[0], at[1])] += 1
    assert Counter(map(tuple, substrings.repeated_spans(docs).collect())) == expected and expected
    assert substrings.repeated_spans(empty).count() == 0


def brute_scores(rows, min_count):
    training = [r for r in rows if zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 10]
    text_tokens = lambda r: [*words(r[1]), b"\n"]
    c = Counter(w for r in training for w in text_tokens(r))
    n, v = sum(c.values()), len(c)
    pairs = Counter(p for r in training for p in zip([b"\n\n", *text_tokens(r)], text_tokens(r)))
    before = Counter(w for _, w in pairs)
    after = defaultdict(list)
    for (a, _), k in pairs.items():
        after[a].append(k)
    of = lambda counts: tuple(sum(k == i for k in counts) for i in range(1, 5))
    d1, d2 = ngram.discounts(of(before.values())), ngram.discounts(of(pairs.values()))
    types = len(pairs)
    spare = sum(d1[min(k, 3)] for k in before.values()) / types
    out = []
    for r in rows:
        own = text_tokens(r)
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        score = 0.0
        for a, w in zip([b"\n\n", *own], own):
            lower = max(before[w] - d1[min(before[w], 3)], 0) / types + spare / (v + 1)
            total = sum(after[a])
            p = lower
            if total:
                k = pairs[(a, w)] if pairs[(a, w)] >= min_count else 0
                left = sum(d2[min(x, 3)] if x >= min_count else x for x in after[a])
                p = max(k - d2[min(k, 3)], 0) / total + left / total * lower
            score += math.log10(p)
        out.append((r[0], len(own), sum(c[w] > 0 for w in own), n, base, score))
    return out


@pytest.mark.parametrize("min_count,per_shard", [(1, 4_000_000), (2, 500)])
def test_ngram_scores(docs, rows, empty, monkeypatch, min_count, per_shard):
    monkeypatch.setattr(ngram, "TOKENS_PER_SHARD", per_shard)
    monkeypatch.setattr(ngram, "WORDS_PER_PART", 100 if per_shard == 500 else 8_000_000)
    monkeypatch.setattr(ngram, "HOT_SHARE", 1 / 100)
    key = lambda x: (x[0] is None, x[0] or 0, x[1], round(x[4], 6))
    expected = sorted(brute_scores(rows, min_count), key=key)
    got = ngram.trained_and_scored(docs, min_count=min_count).collect()
    got = sorted(
        ((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in got), key=key
    )
    assert [g[:4] for g in got] == [e[:4] for e in expected]
    assert np.allclose([g[4:] for g in got], [e[4:] for e in expected], rtol=1e-9)
    if min_count == 1:
        assert ngram.trained_and_scored(empty).count() == 0


def brute_trigram_scores(rows):
    training = [r for r in rows if zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 10]
    padded = lambda r: [b"\n\n", *words(r[1]), b"\n"]
    tri, two = Counter(), Counter()
    for r in training:
        own = padded(r)
        tri.update(zip(own, own[1:], own[2:]))
        two.update(zip(own, own[1:]))
    pairs = Counter((b, c) for _, b, c in tri) | Counter({p: k for p, k in two.items() if p[0] == b"\n\n"})
    ones = Counter(w for _, w in two)
    of = lambda counts: tuple(sum(k == i for k in counts) for i in range(1, 5))
    tables = []
    for grams in (tri, pairs):
        after = defaultdict(list)
        for gram, k in grams.items():
            after[gram[:-1]].append(k)
        tables.append((grams, after, ngram.discounts(of(grams.values()))))
    d1, vocabulary = ngram.discounts(of(ones.values())), len(set(ones))
    spare = sum(d1[min(k, 3)] for k in ones.values()) / len(two)

    def probability(gram):
        if len(gram) == 1:
            k = ones[gram[0]]
            return max(k - d1[min(k, 3)], 0) / len(two) + spare / (vocabulary + 1)
        lower = probability(gram[1:])
        grams, after, d = tables[3 - len(gram)]
        seen, k = after.get(gram[:-1], []), grams[gram]
        if not seen:
            return lower
        return (max(k - d[min(k, 3)], 0) + sum(d[min(x, 3)] for x in seen) * lower) / sum(seen)

    out = []
    for r in rows:
        own = padded(r)
        out.append((r[0], len(own) - 1, sum(math.log10(probability(tuple(own[max(0, i - 2) : i + 1]))) for i in range(1, len(own)))))
    return out


@pytest.mark.parametrize("per_shard,hot", [(4_000_000, 1 / 500), (500, 1 / 2000)])
def test_trigram_scores(docs, rows, empty, spark, monkeypatch, tmp_path, per_shard, hot):
    monkeypatch.setattr(ngram, "TOKENS_PER_SHARD", per_shard)
    monkeypatch.setattr(ngram, "HOT_SHARE", hot)
    key = lambda x: (x[0] is None, x[0] or 0, x[1], round(x[2], 6))
    expected = sorted(brute_trigram_scores(rows), key=key)
    docs.select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op5_lm_scoring(spark, str(tmp_path)).collect()
    got = sorted(((r["doc_id"], r["n_tokens"], r["score"]) for r in got), key=key)
    assert [g[:2] for g in got] == [e[:2] for e in expected]
    assert np.allclose([g[2] for g in got], [e[2] for e in expected], rtol=1e-9)
    assert ngram.trained_and_scored(empty, order=3).count() == 0
    blank = docs.filter("text = ''")
    assert ngram.trained_and_scored(blank.union(blank.withColumn("doc_id", F.lit(1))), order=3).count() == 2


def test_url_rules_and_graph(spark):
    html = lambda *hosts: "".join(f'<a href="https://{h}/x">x</a>' for h in hosts)
    data = [
        (1, "http://A.example.NET/en/1?x=/de/", None),
        (2, "https://a.example.net/fr", ""),
        (3, "https://www.example.com/de/#a", html("bad.net")),
        (4, "https://example.com/fr/", None),
        (5, "https://b.org/fr/x", html("clean.info")),
        (6, "https://farm.info?y", html("bad.net", "worse.net", "bad.net")),
        (7, "https://clean.info/", "<p>no links</p>"),
        (8, "no scheme", None),
        (9, None, None),
        (10, "http://bad.net/a", None),
        (11, "http://worse.net/a", None),
        (12, "http://notexample.net", None),
        (13, "http://bad.net/b", None),
        (14, "http://worse.net/b", None),
        (15, "http://worse.net/c", None),
    ]
    pages = spark.createDataFrame(data + [data[0]], "page_id long, url string, html string")
    got = {r["page_id"]: tuple(r)[1:] for r in links.judged(pages).collect()}
    assert got[1] == ("a.example.net", "/en/1", "example.net/en/", "allow")
    assert got[2] == ("a.example.net", "/fr", "net/", "block")
    assert got[3][2:] == ("example.com/de/", "block")
    assert got[5] == ("b.org", "/fr/x", "org/fr/", "allow")
    assert got[6] == ("farm.info", "", None, "block")
    assert got[7][2:] == (None, "allow")
    assert got[8] == got[9] == ("", "", None, "allow")
    assert got[12] == ("notexample.net", "", None, "allow")
    assert links.judged(pages.filter("false")).count() == 0


def test_uncrawled_hosts_are_part_of_the_graph(spark):
    link = '<a href="http://spam.net/x">x</a>'
    data = [
        (1, "http://farm.info/", link),
        (2, "http://x.site.com/1", None),
        (3, "http://x.site.com/2", None),
        (4, "http://x.site.com/3", None),
        (5, "http://deep.y.site.com/", None),
        (6, "http://y.other.com/", None),
        (7, "http://1.2.3.4/", None),
    ]
    pages = spark.createDataFrame(data, "page_id long, url string, html string")
    rules = (("block", "net", "/"), ("block", "x.site.com", "/"))
    got = {r["page_id"]: r["verdict"] for r in links.judged(pages, rules, threshold=0.3).collect()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "block", 5: "block", 6: "allow", 7: "allow"}
    hosts = spark.createDataFrame([("deep.y.site.com", 1, 0), ("1.2.3.4", 0, 0)], "host string, allowed long, blocked long")
    found = spark.createDataFrame([("1.2.3.4", "spam.net", 2.0)], "source string, target string, weight double")
    nodes, edges = links.graph(hosts, found)
    assert {tuple(r) for r in nodes.collect()} == {
        ("deep.y.site.com", 1, 0), ("y.site.com", 0, 0), ("site.com", 0, 0), ("1.2.3.4", 0, 0), ("spam.net", 0, 1)
    }
    assert {(r["source"], r["target"]) for r in edges.collect()} == {
        ("deep.y.site.com", "y.site.com"), ("y.site.com", "deep.y.site.com"),
        ("y.site.com", "site.com"), ("site.com", "y.site.com"), ("1.2.3.4", "spam.net"),
    }


def test_propagation_is_pagerank(spark):
    rng = random.Random(4)
    hosts = [(f"h{i}", rng.randrange(5), rng.randrange(5)) for i in range(12)]
    edges = list({(f"h{rng.randrange(12)}", f"h{rng.randrange(12)}") for _ in range(40)})
    edges = [(a, b, float(rng.randint(1, 3))) for a, b in edges if a != b]
    got = links.propagated(
        spark.createDataFrame(hosts, "host string, allowed long, blocked long"),
        spark.createDataFrame(edges, "source string, target string, weight double"),
    )
    found = {r["host"]: (r["trust"], r["distrust"]) for r in got.collect()}
    for side, column, flip in ((0, 1, False), (1, 2, True)):
        graph = [(b, a, w) if flip else (a, b, w) for a, b, w in edges]
        out = Counter()
        for a, _, w in graph:
            out[a] += w
        state = {h[0]: 0.15 * h[column] for h in hosts}
        for _ in range(links.ROUNDS):
            passed = Counter()
            for a, b, w in graph:
                passed[b] += state[a] * w / out[a]
            state = {h[0]: 0.15 * h[column] + 0.85 * passed[h[0]] for h in hosts}
        for host, value in state.items():
            assert math.isclose(found[host][side], value, rel_tol=1e-9, abs_tol=1e-12)


def test_language_on_held_out_rows(spark, tables, docs, empty):
    table = spark.read.parquet(f"{tables}/documents.parquet")
    joined = language.predict(table).join(table.select("doc_id", "lang", "text"), "doc_id")
    held = joined.filter("held_out AND length(text) > 100").collect()
    right = sum(r["lang"] == r["lang_pred"] for r in held)
    assert len(held) > 20 and right >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in held)
    got = {r["doc_id"]: r for r in language.predict(docs).collect()}
    for doc, text in ((56, None), (57, ""), (58, " \n\t ")):
        assert got[doc]["lang_pred"] == "und" and got[doc]["score"] == 0.0
    assert {r["lang_pred"] for r in got.values()} <= {"en", "de", "und"}
    assert language.predict(empty).count() == 0
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language.predict(unlabelled).collect()} == {"und"}


@pytest.mark.parametrize("languages", [2, 3, 4, 7, 8, 30])
def test_codewords_differ(languages):
    code = language.codewords(languages)
    for i in range(languages):
        for j in range(i):
            assert (code[i] != code[j]).sum() >= max(1, code.shape[1] // 4)


ODD = [
    "", " ", "  ", "\n", "\n\n a", "a\n", " a", "a  b ", "x▁y", "▁", "▁▁ a", "a\tb\r\nc", "<s>x</s>", "é é　b",
    "a" * 300, "foo.\n  bar\n\n", "   \n   ", "😀 ⅷ\x00z", "tail \n head",
]


def test_token_counts(spark, tables, docs, empty):
    sp = tokens.encoder(tokens.model_path())
    rng = random.Random(9)
    texts = ODD + ["".join(rng.choice(" \n▁ab.é<1\r") for _ in range(rng.randint(1, 60))) for _ in range(300)]
    known = tokens.Lengths(sp, {})
    assert known.of(texts) == [len(sp.encode(t)) for t in texts]
    table = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text")
    for frame in (table, docs.select("doc_id", "text")):
        expected = Counter((r["doc_id"], len((r["text"] or "").encode()), len(sp.encode(r["text"] or ""))) for r in frame.collect())
        got = Counter((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in tokens.token_counts(frame).collect())
        assert got == expected
    assert tokens.token_counts(empty).count() == 0
