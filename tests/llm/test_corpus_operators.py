"""Each corpus operator against a brute-force version, and over odd rows."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from playlake.llm import fingerprints, hostrules, importance, licenses, mixing, packing, sharding, simhash, suffixes, warc
from tests.llm.conftest import COLUMNS, bag, odd_rows

BLANKS = " \t\n\x0b\x0c\r"


def words_of(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if c in BLANKS:
            out += [word] if word else []
            word = ""
        else:
            word += c
    return out


# mixing


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, epochs=2):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), share * sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > epochs * sizes[s]}
        if not over:
            target |= {s: left * weight[s] / total for s in open_}
            break
        target |= {s: epochs * sizes[s] for s in over}
        left -= sum(epochs * sizes[s] for s in over)
        open_ -= over
    return target


def test_targets_are_reshared_until_none_is_above(spark, odd):
    got = {r.source: r.target for r in mixing.source_targets(mixing._sized(odd)).collect()}
    sizes = defaultdict(int)
    for _, text, _, source, _ in odd_rows():
        sizes[source] += len(words_of(text))
    want = brute_targets(sizes)
    assert got.keys() == want.keys()
    for source, target in want.items():
        assert got[source] == pytest.approx(target)


def test_mix_reaches_its_targets_and_repeats_itself(clashing):
    rows = mixing.taken_words(clashing, block_words=16).collect()
    assert len(rows) == len(odd_rows())
    assert all(0 <= r.taken <= 2 * r.size for r in rows)
    by_source = defaultdict(int)
    for r in rows:
        by_source[r.source_size, r.target] += r.taken
    for (size, target), taken in by_source.items():  # two sources may be alike
        assert size == 0 or taken and taken % int(target) == 0
    assert Counter(rows) == Counter(mixing.taken_words(clashing, block_words=16).collect())


def test_every_stretch_of_the_mix_is_near_the_weights(spark):
    docs = spark.createDataFrame([(i, f"{i} " * 50, lang, f"s{i % 5}", 0) for i in range(400) for lang in ["en"]], COLUMNS)
    placed, pieces = mixing.mix(docs, block_words=50)
    share = {r.source_no: r.target for r in placed.select("source_no", "target").distinct().collect()}
    total = sum(share.values())
    slots = sorted(pieces.select("slot", "source_no").distinct().collect())
    for n in (40, 100, len(slots)):
        seen = Counter(s.source_no for s in slots[:n])
        for source, target in share.items():
            assert abs(seen[source] - n * target / total) <= 4
    spans = pieces.groupBy("source_no").sum("words").collect()
    assert {r[0]: r[1] for r in spans} == {s: int(t) for s, t in share.items()}


def test_schedule_gives_every_slot_its_owner(spark, monkeypatch):
    """With several rows of cells: the owner of each slot's point, one by one."""
    monkeypatch.setattr(mixing, "_CELLS_PER_ROW", 8)
    sizes = [40_000, 3, 700, 1, 90_000, 0, 12_345]
    targets = spark.createDataFrame([(f"s{i}", i + 1, n, float(n)) for i, n in enumerate(sizes)],
                                    "source string, source_no long, source_size long, target double")
    got = {r.slot: r.source_no for r in mixing.schedule(targets, 1000).collect()}
    total, want = sum(sizes), {}
    slots = -(-total // 1000)
    for slot in range(slots):
        x, at = int(f"{slot:040b}"[::-1], 2) / (1 << 40), 0
        for i, n in enumerate(sizes):
            at += n
            if n >= 1 and x < at / total:
                want[slot] = i + 1
                break
    assert {k: v for k, v in got.items() if k < slots} == want
    assert set(got.values()) == {i + 1 for i, n in enumerate(sizes) if n}


def test_rows_without_an_id_fill_many_parts(spark):
    docs = spark.createDataFrame([(None, f"one two w{i}", "en", "a", 0) for i in range(400)], COLUMNS)
    sized = mixing._sized(docs)
    placed = mixing.streamed(sized, mixing.source_targets(sized))
    assert {r.start for r in placed.collect()} == {3 * i for i in range(400)}
    keys = placed.select(mixing.shuffled_key(mixing.SEED, "doc_id", "tie").alias("k")).distinct().count()
    assert keys == 400
    rows = sharding.shard_rows(docs).collect()
    assert sorted(Counter(r.shard for r in rows).values())[0] >= 16 and len({(r.shard, r.slot) for r in rows}) == 400


def test_mixed_documents_are_cut_where_the_target_ends(odd, empty):
    mixed = mixing.mixed_documents(odd)
    assert mixed.columns == odd.columns
    whole, taken = Counter(), Counter()
    for r in mixed.collect():
        taken[r.source] += len(words_of(r.text))
        whole[r.text] += 1
    for r in mixing.source_targets(mixing._sized(odd)).collect():
        assert taken[r.source] == int(r.target)
    texts = {t for _, t, *_ in odd_rows()}
    assert sum(n for t, n in whole.items() if t not in texts) <= 5  # the last one of a source
    assert mixing.mixed_documents(empty).count() == 0
    assert mixing.taken_words(empty).count() == 0


# fingerprints


def shingles(text, width=5):
    words = words_of(text)
    return {tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def test_sketches_estimate_sets_and_merge():
    random.seed(5)
    text = [f"t{random.randrange(10**6)}" for _ in range(3000)]
    a, b = " ".join(text[:2000]), " ".join(text[1000:])
    fa, fb = (fingerprints.sketch(t.encode()) for t in (a, b))
    sa, sb = shingles(a), shingles(b)
    assert abs(fingerprints.resemblance(fa, fb) - len(sa & sb) / len(sa | sb)) < 0.15
    assert abs(fingerprints.containment(fa, fb) - len(sa & sb) / len(sa)) < 0.2
    assert abs(fingerprints.distinct_shingles(fa) / len(sa) - 1) < 0.3
    parts = fingerprints.merged(fingerprints.sketch(" ".join(text[:504]).encode()), fingerprints.sketch(" ".join(text[500:2000]).encode()))
    assert (parts == fa).all()
    assert (fingerprints.from_text(fingerprints.to_text(fa)) == fa).all()
    few, more = "a b c d e f g h", "a b c d e f g x"
    exact = len(shingles(few) & shingles(more)) / len(shingles(few) | shingles(more))
    assert fingerprints.resemblance(fingerprints.sketch(few.encode()), fingerprints.sketch(more.encode())) == exact


def test_fingerprints_in_dataframes(spark):
    from pyspark.sql import functions as F

    a, b = "a b c d e f g h", "d e f g h i j k"
    df = spark.createDataFrame([(a, b), (a, None), (None, "")], "x string, y string")
    got = df.select(
        fingerprints.likeness(fingerprints.fingerprint("x"), fingerprints.fingerprint("y")).alias("like"),
        fingerprints.contained(fingerprints.fingerprint("x"), fingerprints.fingerprint("y")).alias("inside"),
        fingerprints.shingle_count(fingerprints.merge(fingerprints.fingerprint("x"), fingerprints.fingerprint("y"))).alias("n"),
    ).collect()
    both, either = len(shingles(a) & shingles(b)), len(shingles(a) | shingles(b))
    assert [tuple(r) for r in got] == [(both / either, both / 4, either), (0.0, 0.0, 4), (1.0, 1.0, 0)]


def test_edited_texts_come_from_the_next_smaller_id(spark, clashing, empty):
    rows = [(i, "".join(random.Random(i).choices("ab é\U0001f600 ", k=i % 40)), "en", "s", 0) for i in range(300)]
    docs = spark.createDataFrame(rows, COLUMNS).repartition(7)
    got = {r.doc_id: r for r in fingerprints.compare_with_edited(docs).collect()}
    assert len(got) == 300
    for i, text, *_ in rows:
        after = rows[i - 1][1]  # of 0: the first, 299
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        assert got[i].n_chars == len(text)
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b, c = shingles(text), shingles(edited), shingles(after)
        assert got[i].near_edited == (len(a & b) / len(a | b) if a | b else 1.0)
        assert got[i].near_next == (len(a & c) / len(a | c) if a | c else 1.0)
    found = fingerprints.compare_with_edited(clashing).collect()
    assert Counter(r.doc_id for r in found) == Counter(i for i, *_ in odd_rows())
    prints = defaultdict(set)
    for r in found:
        prints[r.doc_id].add(r.fingerprint)
    assert prints[1] == prints[2] != prints[3]
    assert fingerprints.compare_with_edited(empty).count() == 0
    one = fingerprints.compare_with_edited(spark.createDataFrame(rows[7:8], COLUMNS)).collect()
    assert one[0].near_next == 1.0


def test_rows_without_an_id_follow_by_their_hashes_in_many_ranges(spark):
    texts = [f"{i} " + "".join(random.Random(i).choices("abc ", k=30)) for i in range(400)]
    docs = spark.createDataFrame([(None if i > 3 else i, t, "en", "s", 0) for i, t in enumerate(texts)], COLUMNS).repartition(5)
    ties = {r.text: r.tie for r in docs.selectExpr("text", "xxhash64(text) AS tie").collect()}
    order = [*texts[3::-1], *sorted(texts[4:], key=ties.get)]
    want = Counter()
    for text, after in zip(order, [*order[1:], order[0]], strict=True):
        keep = len(text) - len(text) // 2
        want[hashlib.sha256((text[:keep] + after[:len(text) // 2]).encode()).hexdigest()] += 1
    assert Counter(r.edited_sha256 for r in fingerprints.compare_with_edited(docs).collect()) == want
    placed = fingerprints._bucketed(docs.select("doc_id", "text"), 16).where("doc_id IS NULL")
    assert placed.select("range").distinct().count() > 10


# shards


def test_shards_hold_the_mixture(spark, clashing, empty):
    docs = spark.range(5000).selectExpr("id AS doc_id", "if(id % 3 = 0, null, concat('s', id % 7)) AS source")
    rows = sharding.shard_rows(docs, 24).collect()
    sizes = Counter(r.shard for r in rows)
    assert set(sizes) == set(range(24)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard, size in sizes.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(size))
    whole, each = Counter(r.source for r in rows), Counter((r.shard, r.source) for r in rows)
    for source, n in whole.items():
        for shard, size in sizes.items():
            assert abs(each[shard, source] - n * size / 5000) <= 3
    found = sharding.shard_rows(clashing, 24)
    assert found.count() == len(odd_rows()) and found.columns[-2:] == ["shard", "slot"]
    assert bag(found, "doc_id", "text") == bag(clashing, "doc_id", "text")
    assert sharding.shard_rows(empty, 24).count() == 0


# simhash


def brute_print(text, width=3):
    words = words_of("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    runs = [" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    votes = [0] * 64
    for run in runs:
        h = xxhash.xxh64_intdigest(run.encode(), seed=42)
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(runs))


def brute_components(prints, budget=3):
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    listed = sorted(prints)
    for i, a in enumerate(listed):
        for b in listed[:i]:
            if (a ^ b).bit_count() <= budget:
                parent[find(a)] = find(b)
    return {p: find(p) for p in prints}


@pytest.mark.parametrize(("group", "depths"), [(1 << 18, (4, 8, 12)), (30, (4, 8, 12)), (3, (4, 8, 12)), (1, (4,))])
def test_the_trie_finds_all_links(spark, monkeypatch, group, depths):
    monkeypatch.setattr(simhash, "GROUP", group)  # also enters groups below their root
    monkeypatch.setattr(simhash, "DEPTHS", depths)  # and groups that are too large for the last depth
    random.seed(group)
    centres, prints = [random.getrandbits(64) for _ in range(15)], set()
    while len(prints) < 300:
        p = random.choice(centres)
        for _ in range(random.randint(0, 9)):
            p ^= 1 << random.randrange(64)
        prints.add(p)
    signed = {p: p - (1 << 64) if p >> 63 else p for p in prints}
    found = simhash.components(simhash.linked_fingerprints(spark.createDataFrame([(p,) for p in signed.values()], "print long")))
    labels = {r.node: r.root for r in found.collect()}
    groups = defaultdict(set)
    for p, root in brute_components(prints).items():
        groups[root].add(signed[p])
    for members in groups.values():
        assert {labels.get(p, p) for p in members} == {min(members)}


def test_near_duplicates_equal_brute_force(clashing, empty):
    rows = odd_rows()
    prints = {brute_print(t) for _, t, *_ in rows}
    root = brute_components(prints)
    least = {}
    for i, text, *_ in rows:
        r = root[brute_print(text)]
        least[r] = min((x for x in (least.get(r), i) if x is not None), default=None)
    want = Counter((i, brute_print(t), least[root[brute_print(t)]]) for i, t, *_ in rows)
    got = Counter((r.doc_id, r.fingerprint % (1 << 64), r.component_id) for r in simhash.near_duplicates(clashing).collect())
    assert got == want
    assert simhash.near_duplicates(empty).count() == 0


def test_one_of_each_component_stays(odd, empty):
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[1] == 1 and ids[2] == 0 and ids[12] == 1 and ids[None] == 0 and ids[4] == 1 and ids[5] == 0
    assert max(ids.values()) == 1
    assert simhash.one_of_each(empty).count() == 0


def test_rows_that_share_an_id_are_judged_by_their_own_text(spark, clashing):
    one, other, third = (" ".join(f"{c}{k}" for k in range(60)) for c in "pqr")
    rows = [(1, one, "en", "s", 0), (2, one, "en", "t", 0), (2, other, "en", "s", 0), (1, one, "en", "s", 0), (None, one, "en", "s", 0),
            (None, third, "en", "s", 0), (None, third, "en", "s", 0)]
    kept = simhash.one_of_each(spark.createDataFrame(rows, COLUMNS)).collect()
    assert Counter((r.doc_id, r.text) for r in kept) == Counter([(1, one), (2, other), (None, third)])
    assert simhash.one_of_each(clashing).columns == clashing.columns
    assert Counter(r.doc_id for r in simhash.one_of_each(clashing).collect()) == Counter([1, 3, 4, 7, 8, 9, 10, 11, 12, 13, 14])


def test_a_chain_is_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long")
    assert {r.root for r in simhash.components(links).collect()} == {0}


# packing


def test_best_fit_fills_and_shrinks():
    random.seed(2)
    sizes = sorted((random.choice([3, 40, 300, 700, 1500, 5000, 8192]) for _ in range(3000)), reverse=True)
    bins, offsets, capacity = packing.best_fit(sizes)
    spans = defaultdict(list)
    for which, offset, size in zip(bins, offsets, sizes, strict=True):
        spans[which].append((offset, offset + size))
    for which, parts in spans.items():
        parts.sort()
        assert parts[0][0] == 0 and all(a[1] == b[0] for a, b in zip(parts, parts[1:], strict=False))
        assert capacity[which] == min(n for n in packing.LENGTHS if n >= parts[-1][1])
    assert sum(sizes) / sum(capacity) > 0.95  # a piece of 5000 has to lie in 8192
    one_size = sum(map(packing.cost, packing.best_fit(sizes, (8192,))[2]))
    assert sum(map(packing.cost, capacity)) <= one_size
    # where pieces are of middling size, a shorter length is cheaper than the longest
    joint, longest = (sum(map(packing.cost, packing.best_fit([600] * 100, n)[2])) for n in (packing.LENGTHS, (8192,)))
    assert joint < 0.9 * longest


def test_packing_equals_brute_force(spark):
    """Every piece tried in every open bin; of bins with equal room the one that got it last."""
    chance = random.Random(5)
    docs = [(i, "w " * chance.choice([0, 3, 40, 300, 511, 512, 700, 1500, 9000, 20_000]), "en", "a", 0) for i in range(150)]
    rows = packing.packed(spark.createDataFrame(docs, COLUMNS)).collect()
    sizes = sorted((min(8192, len(words_of(t)) - at) for _, t, *_ in docs for at in range(0, len(words_of(t)), 8192)), reverse=True)
    bins, clock = [], 0  # room, filled, time of the last change
    for k, size in enumerate(sizes):
        clock += 1
        fits = [b for b in bins if b[0] >= size]
        if not fits:
            rest = sizes[k + 1:]
            room = sum(b[0] for b in bins)

            def per_word(length, size=size, rest=rest, room=room):
                filling = sum(s for s in rest if s <= length - size)
                return packing.cost(length) / (size + min(length - size, max(0, filling - room)))

            bins.append([min((n for n in packing.LENGTHS if n >= size), key=per_word), 0, clock])
            fits = bins[-1:]
        chosen = min(fits, key=lambda b: (b[0], -b[2]))
        chosen[0], chosen[1], chosen[2] = chosen[0] - size, chosen[1] + size, clock
    got = defaultdict(int)
    for r in rows:
        if r.n_words:
            got[r.bin, r.bin_size] += r.n_words
    assert Counter((size, filled) for (_, size), filled in got.items()) == Counter(
        (min(n for n in packing.LENGTHS if n >= filled), filled) for _, filled, _ in bins)


def test_groups_are_dealt_by_pieces(spark):
    docs = spark.createDataFrame([(i, "w " * 40_000, "en", "a", 0) for i in range(20)], COLUMNS)
    groups = {r.bin >> 32 for r in packing.packed(docs, group_pieces=10).collect()}
    assert len(groups) > 4  # 100 pieces of 20 documents


def test_copies_of_a_row_are_dealt_to_many_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "_COPIES", 7)
    docs = spark.createDataFrame([(1, "w " * 600, "en", "a", 0)] * 100 + [(2, "w w", "en", "a", 0)], COLUMNS)
    rows = packing.packed(docs, group_pieces=10).collect()
    assert Counter((r.doc_id, r.n_words) for r in rows) == {(1, 600): 100, (2, 2): 1}
    assert len({r.bin >> 32 for r in rows}) > 5
    places = {(r.bin, r.offset) for r in rows}
    assert len(places) == 101

def test_packing_places_every_word_once(clashing, empty):
    rows = packing.packed(clashing).collect()
    words = Counter()
    for r in rows:
        words[r.doc_id] += r.n_words
        assert (r.bin is None) == (r.n_words == 0)
        assert r.n_words == 0 or r.offset + r.n_words <= r.bin_size
    want = Counter()
    for i, text, *_ in odd_rows():
        want[i] += len(words_of(text))
    assert +words == +want
    taken = sorted((r.bin, r.offset, r.n_words) for r in rows if r.n_words)
    assert all(a[0] != b[0] or a[1] + a[2] == b[1] for a, b in zip(taken, taken[1:], strict=False))
    assert packing.packed(empty).count() == 0


# licences


@pytest.mark.parametrize(("expression", "value", "names"), [
    ("MIT", 1.0, ["MIT"]),
    ("MIT OR GPL-3.0-only", 1.0, ["MIT", "GPL-3.0-only"]),
    ("MIT and GPL-3.0", 0.2, ["MIT", "GPL-3.0"]),
    ("GPL-2.0 WITH Classpath-exception-2.0 AND MIT", 0.3, ["GPL-2.0", "MIT"]),
    ("MIT OR GPL-2.0 AND AGPL-3.0", 1.0, ["MIT", "GPL-2.0", "AGPL-3.0"]),
    ("(MIT OR GPL-2.0) AND AGPL-3.0", 0.1, ["MIT", "GPL-2.0", "AGPL-3.0"]),
    ("MIT */", 1.0, ["MIT"]),
])
def test_expressions(expression, value, names):
    got = licenses.evaluate(expression)
    assert got[0] == pytest.approx(value) and got[1] == names


@pytest.mark.parametrize("expression", ["", "AND", "MIT OR", "(MIT", "OR MIT", "()"])
def test_malformed_expressions(expression):
    assert licenses.evaluate(expression) is None


def test_scan_equals_brute_force(spark, clashing):
    from pyspark.sql import functions as F

    texts = ["Released under the MIT License. mit-license, MIT license mit license", "CC-BY 4.0 / cc by", None, "", "the apache license",
             "GNU  General,Public\nLicense version 3", "// SPDX-License-Identifier: Apache-2.0 OR MIT\nx", "cc by cc by nc 4 0", "Ümit license"]
    got = (spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
           .select("i", licenses.license_scan(F.col("text")).alias("f")).select("i", "f.*").orderBy("i").collect())
    for r, text in zip(got, texts, strict=True):
        cleaned = "".join(c.lower() if "A" <= c <= "Z" else c if c.isascii() and c.isalnum() or ord(c) > 127 else " " for c in text or "")
        words = [w for w in cleaned.split(" ") if w]
        places = [(i, label) for phrase, label in licenses.BASE.items() for i in range(len(words))
                  if words[i:i + len(phrase.split())] == phrase.split()]
        assert (r.n_words, r.n_base) == (len(words), len(places))
        assert r.first_word == min((i for i, _ in places), default=None)
        assert r.last_word == max((i for i, _ in places), default=None)
        assert r.base_labels == ",".join(sorted({label for _, label in places}))
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert got[6].labels == "spdx:Apache-2.0,spdx:MIT" and got[6].score == 1.0
    rest = clashing.select(licenses.license_scan(clashing["text"]).alias("f")).collect()
    assert len(rest) == len(odd_rows())
    assert clashing.limit(0).select(licenses.license_scan(clashing["text"]).alias("f")).count() == 0


@pytest.mark.parametrize(("text", "score", "labels"), [
    ("gnu general public license and mit license", 0.2, "gpl,mit,spdx:MIT"),
    ("the apache license", 0.95, "apache"),
    ("Apache License, Version 2.0 or CC BY 4.0", 0.9, "apache,cc-by,spdx:Apache-2.0,spdx:CC-BY-4.0"),
    ("cc by", 0.9, "cc-by"),
    ("é SPDX-License-Identifier: AGPL-3.0\nLicense-Expression : MIT OR X", 0.1, "spdx:AGPL-3.0,spdx:MIT,spdx:X"),
    ("spdx license identifier MPL, license expression", 0.0, ""),
])
def test_scores_and_tags(text, score, labels):
    found = licenses.scan(text.encode(), licenses.automaton())
    assert found[-1] == pytest.approx(score) and found[-2] == labels


# importance


def test_weights_tell_good_text_from_bad_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    good = [(r.doc_id,) for r in labels if r.quality == 1 and r.toxic == 0 and r.doc_id % 2 == 0]
    found = {r.doc_id: r.log_weight for r in importance.resampled(docs, spark.createDataFrame(good, "doc_id long")).collect()}
    held = [(found[r.doc_id], r.quality) for r in labels if r.doc_id % 2]
    high, low = [w for w, q in held if q], [w for w, q in held if not q]
    ahead = np.mean([(a > b) + (a == b) / 2 for a in high for b in low])
    assert ahead > 0.7, ahead


def test_weights_equal_brute_force_and_whole_long_texts_count(spark, odd):
    good_ids = {1, 8, 12}
    ratio = {}
    raw, good = Counter(), Counter()

    def grams(text):
        words = words_of("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        bucket = lambda t: ratio.setdefault(t, importance.buckets_of(t.encode())[-1])
        return [bucket(w) for w in words] + [bucket(f"{a} {b}") for a, b in zip(words, words[1:], strict=False)]

    rows = [(i, grams(text)) for i, text, *_ in odd_rows()]
    for i, found in rows:
        raw.update(found)
        good.update(found if i in good_ids else ())
    n, total, wanted = importance.BUCKETS, sum(raw.values()), sum(good.values())
    weight = lambda b: math.log((good[b] + 1) / (wanted + n)) - math.log((raw[b] + 1) / (total + n))
    want = sorted(sum(map(weight, found)) for _, found in rows)
    got = importance.resampled(odd, spark.createDataFrame([(i,) for i in good_ids], "doc_id long")).collect()
    assert sorted(r.log_weight for r in got) == pytest.approx(want)


def test_exactly_the_largest_scores_are_kept(spark, clashing, empty):
    good = spark.createDataFrame([(1,), (3,), (None,)], "doc_id long")
    rows = importance.resampled(clashing, good, keep=0.5).collect()
    kept = [r.score for r in rows if r.kept]
    assert len(rows) == len(odd_rows()) and len(kept) == len(rows) // 2
    assert min(kept) >= max(r.score for r in rows if not r.kept)
    assert importance.resampled(empty, good).count() == 0


@pytest.mark.parametrize("values", [[5.0] * 50, [*range(100)], [1.0, 1.0, 2.0] * 40, [-1.5, 3.25], [0.0] * 60 + [1.0] * 3 + [-1.0] * 2])
def test_thresholds_equal_sorting(spark, values):
    table = spark.createDataFrame([(float(v),) for v in values], "x double")
    order = sorted(map(float, values), reverse=True)
    for wanted in {1, 2, len(values) // 2, len(values) - 1, len(values)}:
        found, ties = importance.threshold(table, "x", wanted, few=1, bins=4)
        assert found == order[wanted - 1] and ties == wanted - sum(v > found for v in values)


def test_repeated_rows_fill_up_the_share(spark):
    docs = spark.createDataFrame([(1, "same text", "en", "a", 0)] * 90 + [(i, f"w{i}", "en", "a", 0) for i in range(2, 12)], COLUMNS)
    rows = importance.resampled(docs, spark.createDataFrame([(1,)], "doc_id long"), keep=0.5).collect()
    assert sum(r.kept for r in rows) == 50
    bare = docs.selectExpr("cast(null AS bigint) AS doc_id", "text").limit(60)
    assert len({r.score for r in importance.resampled(bare, spark.createDataFrame([(1,)], "doc_id long")).collect()}) == 60


def test_noise_is_gumbel(spark):
    values = np.array([r[0] for r in spark.range(20_000).select(importance.gumbel(3, "id")).collect()])
    assert abs(values.mean() - 0.5772) < 0.05 and abs(values.std() - 1.2825) < 0.05


# host rules


def test_hosts_that_fail_are_dropped_whole(spark, clashing, empty):
    fine = " ".join(f"w{i}" for i in range(80))
    rows = ([(i, "short", "en", "bad", 0) for i in range(200)] + [(200, fine, "en", "bad", 0)]
            + [(300 + i, fine + str(i), "en", "good", 0) for i in range(100)]
            + [(500, "short", "en", "small", 0), (501, fine + "x", "en", "small", 0)]
            + [(600 + i, fine + f" {i}", "en", None, 0) for i in range(50)])
    kept = {r.doc_id for r in hostrules.kept_documents(spark.createDataFrame(rows, COLUMNS)).collect()}
    assert kept == {*range(300, 400), 501, *range(600, 650)}
    found = hostrules.judged(clashing).collect()
    assert Counter(r.doc_id for r in found) == Counter(i for i, *_ in odd_rows())
    assert hostrules.kept_documents(empty).count() == 0
    assert hostrules.kept_documents(clashing).columns == clashing.columns


def test_statistics_equal_brute_force():
    for _, text, *_ in [*odd_rows(), (0, "a b c a b c\nx\nx\n \nx # $", 0, 0, 0), (0, "a\x0bb\x1cc\x85d", 0, 0, 0)]:
        if text and len(text) > 20_000:
            continue
        words = words_of(text)
        runs = Counter(zip(words, words[1:], words[2:], strict=False))
        inside = {i + k for i, r in enumerate(zip(words, words[1:], words[2:], strict=False)) if runs[r] > 1 for k in range(3)}
        lines = [x for x in (text or "").split("\n") if words_of(x)]
        assert hostrules.text_statistics((text or "").encode()) == (
            len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(inside))


# WARC


def test_derivatives_refer_to_their_response(spark):
    pages = spark.createDataFrame([
        (1, "http://a/", '<html lang="en"><title>T &amp; U</title><script>x<p></script><p>One<br>two &lt;3<a href="/l">l</a></html>'),
        (2, None, None), (3, "http://b/", ""), (3, "http://b/", ""), (None, "http://c/", "<p>é</p>")], "page_id long, url string, html string")
    records = warc.responses(pages)
    out = warc.derivatives(records).collect()
    assert len(out) == 10
    ids = {warc_field(r.header, "WARC-Record-ID") for r in records.collect()}
    for r in out:
        assert warc_field(r.header, "WARC-Refers-To") == r.refers_to in ids
        assert r.content_length == len(r.block.encode()) == int(warc_field(r.header, "Content-Length"))
        assert r.block_digest == "sha256:" + hashlib.sha256(r.block.encode()).hexdigest()
    first = {r.record_type: r for r in out if r.page_id == 1}
    assert first["conversion"].block == "One\ntwo <3l"
    assert "outlink: /l\r\n" in first["metadata"].block and "title: T &amp; U\r\n" in first["metadata"].block
    assert warc.derivatives(records.limit(0)).count() == 0
    plain = spark.createDataFrame([(1, "WARC/1.1\r\nWARC-Type: request\r\n", "x"), (2, None, "x"), (3, "warc-type: response", "<b>x</b>"), (4, "WARC-Type: response", None)],
                                  "page_id long, header string, block string")
    assert bag(warc.derivatives(plain), "page_id", "record_type", "block") == Counter(
        {(3, "metadata", ""): 1, (3, "conversion", "x"): 1, (4, "metadata", ""): 1, (4, "conversion", ""): 1})


def test_derivatives_of_long_pages_and_clashing_columns(spark):
    long = "<p>" + "word &amp; " * 100_000 + "</p>"
    pages = spark.createDataFrame([(1, "http://a/", long, "x", "y"), (None, None, None, None, None)],
                                  "page_id long, url string, html string, block string, HEADER string")
    out = {(r.page_id, r.record_type): r for r in warc.derivatives(warc.responses(pages)).collect()}
    assert len(out) == 4
    assert out[1, "conversion"].block == ("word & " * 100_000).strip()
    more = warc.responses(pages.drop("block", "HEADER")).selectExpr("*", "'c' AS record_type", "'c' AS refers_to", "'c' AS Block_Digest")
    assert {r.block for r in warc.derivatives(more).collect()} == {r.block for r in out.values()}


def warc_field(header, name):
    return next((line.split(": ", 1)[1] for line in header.split("\r\n") if line.startswith(f"{name}: ")), None)


# suffixes


def test_columns_give_the_suffix_order_and_common_prefixes():
    random.seed(1)
    for _ in range(100):
        strings = [bytes(random.choice(b"ab\x00") for _ in range(random.randint(1, 12))) for _ in range(random.randint(1, 8))]
        suffix, common = suffixes.column_wise(strings, 5)
        entries, at = [], 0
        for i, s in enumerate(strings):
            entries += [(tuple(x + len(strings) for x in s[o:]) + (i,), at + o + i) for o in range(len(s) + 1)]
            at += len(s)
        entries.sort()
        assert [p for _, p in entries] == suffix.tolist()
        for k, ((a, _), (b, _)) in enumerate(zip(entries, entries[1:], strict=False), 1):
            same = next(i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y)
            assert common[k] == min(same, 5)


def brute_kept(rows, span):
    owner = {}
    for i, text, *_ in rows:
        data = (text or "").encode()
        for p in range(len(data) - span + 1) if i is not None else ():
            owner[data[p:p + span]] = min(i, owner.get(data[p:p + span], i))
    kept = Counter()
    for i, text, *_ in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - span + 1) if i is not None else ():
            if owner[data[p:p + span]] < i:
                gone[p:p + span] = b"\1" * span
        kept[i, bytes(b for b, g in zip(data, gone, strict=True) if not g)] += 1
    return kept


@pytest.mark.parametrize(("hot", "chunk_bytes"), [(50_000, 4 << 20), (2, 3_000)])
def test_removed_spans_equal_brute_force(clashing, monkeypatch, hot, chunk_bytes):
    monkeypatch.setattr(suffixes, "HOT", hot)  # also with anchors cut into single windows
    found = suffixes.repeated_spans(clashing, 50, chunk_bytes)
    got = Counter((r.doc_id, bytes(r.kept or b"")) for r in found.collect())
    assert got == brute_kept(odd_rows(), 50)


def test_stages_pass_clashing_columns_on(odd, clashing):
    for stage in (suffixes.without_repeats, mixing.mixed_documents):
        plain, more = stage(odd), stage(clashing)
        assert more.columns == clashing.columns
        assert bag(more, "doc_id", "text", "lang") == bag(plain, "doc_id", "text", "lang")
        assert {r.rest for r in more.collect()} == {"clash"}


def test_text_without_repeats_keeps_whole_characters(odd, empty):
    out = {r.doc_id: r for r in suffixes.without_repeats(odd).collect() if r.doc_id}
    assert suffixes.without_repeats(odd).columns == odd.columns
    assert out[2].text == "" and out[2].n_chars == 0 and out[4].text is None and out[1].n_chars is None
    assert out[9].text.startswith("elsewhere") and "lazy dog" not in out[9].text
    assert suffixes.without_repeats(empty).count() == 0
