"""Each operator against a plain version, on a small table of odd rows."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from stewardry.llm import (
    decontaminate,
    jaccard_join,
    mixing,
    quality_cnn,
    quality_rules,
    substring_dedup,
    suffix_dedup,
    token_counts,
    token_files,
    warc,
)
from stewardry.llm.components import components
from stewardry.llm.queries import tokenizer_file


def collected(frame):
    return Counter(tuple(r) for r in frame.collect())


# WARC


def test_warc_round_trip(spark, rows, documents):
    pages = documents.withColumn("url", F.concat(F.lit("http://x/\r\nInjected: "), F.col("source")))
    got = collected(warc.write_and_read(spark, pages, "doc_id", "url", "text"))
    body = lambda t: (t or "").encode()
    first = {}
    for i, t in rows:
        if i is not None and len(body(t)) >= 100:
            first[t] = min(i, first.get(t, i))
    expected = Counter()
    for i, t in rows:
        to = first.get(t)
        to = None if to == i else to
        kind = "response" if to is None else "revisit"
        row = (None if i is None else str(i), len(body(t)), hashlib.sha256(body(t)).hexdigest(), kind, None if to is None else str(to))
        expected[row] += 1
    assert got == expected


def test_warc_chunks_carry_running_digests(spark, documents, tmp_path):
    text = "é" * 100_000
    page = spark.createDataFrame([(1, "u", text)], "page_id long, url string, html string")
    files = warc.write_archives(warc.plan_records(page), f"file://{tmp_path}")
    chunks = warc.read_chunks(spark, files, f"file://{tmp_path}").orderBy("chunk_no").collect()
    whole, digest = b"", hashlib.sha256()
    for n, row in enumerate(chunks):
        whole += row.chunk
        digest.update(row.chunk)
        assert (row.chunk_no, row.bytes_so_far, row.digest_so_far) == (n, len(whole), digest.hexdigest())
        assert len(row.chunk) <= warc.CHUNK_BYTES and row.is_last == (n == len(chunks) - 1)
    assert whole == text.encode()


def test_many_archives_are_read_by_many_tasks(spark, documents, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 0)
    pages = documents.withColumn("url", F.lit("u")).repartition(24)
    files = warc.write_archives(warc.plan_records(pages, "doc_id", "url", "text"), f"file://{tmp_path}")
    assert files.count() >= 24
    read = warc.read_chunks(spark, files, f"file://{tmp_path}").groupBy(F.spark_partition_id()).count().collect()
    assert len(read) > 12


def test_a_long_address_is_read_back(spark):
    long = "data:" + "x y" * 500_000
    pages = spark.createDataFrame([(1, long, "p"), (2, "u", None)], "page_id long, url string, html string")
    assert {(r.page_id, r.payload_bytes) for r in warc.write_and_read(spark, pages).collect()} == {("1", 1), ("2", 0)}


def test_warc_reads_plain_archives_and_rejects_broken_ones(spark, tmp_path):
    import io

    record = b"".join(warc.record(7, "u", memoryview(b"payload"), hashlib.sha256(b"payload").hexdigest(), None, "d"))
    (row,) = warc.chunks(io.BytesIO(record))
    assert (row[0], row[5], row[9]) == ("urn:page:7", b"payload", 7)
    for broken in (record[:-6], record.replace(b"payload\r\n", b"changed\r\n"), b"GET / HTTP/1.1\r\n\r\n"):
        with pytest.raises(ValueError):
            list(warc.chunks(io.BytesIO(broken)))


# Decontamination


def test_items_are_found_and_clean_documents_stay(spark, rows, documents):
    texts = [t for _, t in rows if t]
    item = " ".join(texts[20].split()[:30])
    benchmark = spark.createDataFrame([(1, item), (2, item.upper() + "!"), (3, None), (4, "..."), (None, "never seen words at all here")], "item_id long, text string")
    found = decontaminate.find_items(documents, benchmark)
    plain = lambda t: re.findall(r"\w+", (t or "").lower())
    holders = {i for i, t in rows if " ".join(plain(item)) in " ".join(plain(t))}
    assert holders and {(r.doc_id, r.item_id) for r in found.collect()} == {(i, k) for i in holders for k in (1, 2)}
    kept = decontaminate.without_items(documents, benchmark)
    assert kept.columns == documents.columns
    assert collected(kept) == collected(documents.where(~F.coalesce(F.col("doc_id").isin(*holders), F.lit(False))))


def test_blocks_of_items_find_the_same(documents, spark, monkeypatch):
    texts = [r.text for r in documents.where("doc_id < 12").collect()]
    benchmark = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    whole = collected(decontaminate.find_items(documents, benchmark))
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 5)
    assert collected(decontaminate.find_items(documents, benchmark)) == whole and whole


# Similarity join


def plain_join(rows):
    words = lambda t: tuple(re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (t or "").lower()))
    members = defaultdict(list)
    for i, t in rows:
        members[words(t)].append((i, t))
    sets = {w: {w[k : k + 5] for k in range(len(w) - 4)} for w in members}
    root = {w: w for w in members}

    def top(w):
        while root[w] != w:
            w = root[w]
        return w

    links = Counter()
    for a in sets:
        for b in sets:
            if a < b and sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                links[a] += 1
                links[b] += 1
                root[top(b)] = top(a)
    least = defaultdict(list)
    for w, held in members.items():
        least[top(w)] += [i for i, _ in held if i is not None]
    return Counter((i, min(least[top(words(t))], default=None), len(members[words(t)]) - 1, links[words(t)]) for i, t in rows)


def test_join_finds_every_link(rows, documents, monkeypatch):
    expected = plain_join(rows)
    columns = ["doc", "class_id", "n_copies", "n_links"]
    assert collected(jaccard_join.join_similar(documents).select(*columns)) == expected
    # Small limits, so that nodes are split, tiled and compared across tiles.
    for name, value in {"LEAF": 3, "SKETCH_TILE": 4, "TILE_SETS": 5, "TILE_GRAMS": 900}.items():
        monkeypatch.setattr(jaccard_join, name, value)
    assert collected(jaccard_join.join_similar(documents).select(*columns)) == expected


def test_one_of_each_group_stays(rows, documents):
    kept = jaccard_join.keep_first(documents)
    assert kept.columns == documents.columns
    groups = Counter(row[1] for row in plain_join(rows) if row[1] is not None)
    ids = [r.doc_id for r in kept.where("doc_id IS NOT NULL").collect()]
    assert sorted(ids) == sorted(groups)


def test_runs_follow_the_target():
    assert jaccard_join.runs_for(0.9, 0.8) < jaccard_join.runs_for(0.99999, 0.8)
    assert jaccard_join.runs_for(0.99, 1.0) == 1


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, 100 + i) for i in range(1, 9)] + [(50, 50)]
    found = components(spark.createDataFrame(edges, "a long, b long"))
    assert collected(found) == Counter([(i, 0) for i in range(21)] + [(i, 100) for i in range(100, 109)])


# Quality rules


def test_quality_facts(rows, documents):
    got = {}
    for r in quality_rules.with_facts(documents).collect():
        got[r.text] = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
    for _, t in rows:
        words = [w.decode() for w in (t or "").encode().split()]
        times = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
        held = {j for k in range(len(words) - 2) if times[tuple(words[k : k + 3])] > 1 for j in range(k, k + 3)}
        lines = [line for line in (t or "").split("\n") if line.encode().split()]
        symbols = sum(c in "#*$%&|<>" for c in t or "")
        assert got[t] == (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(held))


def test_bad_hosts_take_their_documents_along(spark):
    good = "plain words of a text that differ all the way " + " ".join(f"w{i}" for i in range(60))
    rows = [(i, good + f" {i}", f"host{i % 5}") for i in range(200)] + [(1000 + i, "short", "spam") for i in range(80)] + [(2000, good, "spam")]
    judged = quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    by_id = {r.doc_id: r for r in judged.collect()}
    assert not by_id[2000].base_failed and by_id[2000].host_failed and not by_id[2000].kept
    assert all(by_id[i].kept for i in range(200))


def test_a_host_of_few_documents_is_shrunk_to_the_rest(spark):
    rows = [(h, k < 1) for h in range(30) for k in range(50)] + [(99, True)]
    failures = spark.createDataFrame(rows, "host long, fails_x boolean")
    rates = {r.host: r.rate_x for r in quality_rules.host_rates(failures, "host", ["x"]).collect()}
    assert rates[0] < rates[99] < 1


def test_quality_keeps_columns(documents):
    assert quality_rules.keep(documents).columns == documents.columns


# Substring dedup


def test_repeated_words_go(rows, documents):
    for width, gram in ((50, 16), (6, 2)):
        first = {}
        split = [(i, (t or "").encode().split()) for i, t in rows]
        for i, w in split:
            for k in range(len(w) - width + 1 if i is not None else 0):
                window = tuple(w[k : k + width])
                first[window] = min(i, first.get(window, i))
        expected = Counter()
        for i, w in split:
            gone = set()
            for k in range(len(w) - width + 1 if i is not None else 0):
                if first[tuple(w[k : k + width])] < i:
                    gone.update(range(k, k + width))
            kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
            expected[i, len(w), len(gone), hashlib.sha256(kept).hexdigest()] += 1
        assert collected(substring_dedup.remove_repeats(documents, width, gram=gram)) == expected


# Token counts and files


def test_token_counts_match_the_library(rows, documents, spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_file())
    more = [(900, "a<|endoftext|> b<|endoftext|>"), (901, "it's  we'll\n\n x\t y "), (902, "z" * 5000)]
    frame = documents.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    expected = Counter()
    for i, t in rows + more:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        expected[i, len((t or "").encode()), n, n > 100] += 1
    assert collected(token_counts.count_tokens(frame, tokenizer_file(), 100)) == expected


def test_a_full_store_of_words_starts_anew(monkeypatch):
    own = token_counts.MergeCounter(tokenizer_file())
    before = [own.count(f"some words number {i} and more") for i in range(50)]
    monkeypatch.setattr(token_counts, "MOST_KEPT", 3)
    fresh = token_counts.MergeCounter(tokenizer_file())
    assert [fresh.count(f"some words number {i} and more") for i in range(50)] == before


def test_token_files_round_trip(spark, rows, documents, monkeypatch):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_file())
    expected, start = Counter(), 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        expected[i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
        start += len(ids)
    assert collected(token_files.write_and_read(spark, documents, tokenizer_file(), 2)) == expected
    monkeypatch.setattr(token_files, "SHARD_BYTES", 500)
    monkeypatch.setattr(token_files, "BUCKET_KEYS", 7)
    assert collected(token_files.write_and_read(spark, documents, tokenizer_file(), 2)) == expected


def test_pieces_have_the_ids_of_the_whole_text(monkeypatch):
    import random

    own = token_files.Encoder(tokenizer_file(), 2)
    draw = random.Random(2)
    parts = ["a", "b", " ", "  ", "\n", ".", ",", "'s", "é", "<|endoftext|>", "\t", " \n", "\xa0", "\x1c", "漢", "1", "!", "Word", "😀", "\x85", "ll"]
    for kept, long in ((800_000, 4 << 20), (50, 4 << 20), (50, 60)):
        own.table.most, own.table.small = kept, kept // 4
        monkeypatch.setattr(token_files, "LONG_BYTES", long)
        texts = ["".join(draw.choices(parts, k=draw.randint(0, 40))) for _ in range(600)]
        for text, ids in zip(texts, own.encode(texts)):
            assert np.frombuffer(ids, own.kind).tolist() == own.library.encode(text, add_special_tokens=False).ids + [2]


def test_index_is_minimal_and_knows_its_keys():
    import pyarrow as pa

    draw = np.random.default_rng(0)
    n = 5000
    table = pa.table(
        {
            "high": draw.integers(-(2**63), 2**63 - 1, n), "low": draw.integers(-(2**63), 2**63 - 1, n),
            "shard": np.zeros(n, np.int32), "offset": np.arange(n), "start": np.arange(n), "n_tokens": np.ones(n, np.int64),
        }
    )
    index = token_files.Index(token_files.pack_index(table))
    slots = index.find(token_files.hash_pair(table))
    assert sorted(slots.tolist()) == list(range(n)) and index.slots["offset"][slots].tolist() == list(range(n))
    strangers = draw.integers(0, 2**63 - 1, (2, n)).astype(np.uint64)
    assert (index.find(strangers) >= 0).sum() <= 1


# Classifier


def spoiled(text):
    return b"##".join(text[i : i + 10] for i in range(0, len(text), 10))


def test_network_learns_and_sees_whole_texts(spark):
    draw = np.random.default_rng(0)
    clean = [bytes(draw.integers(97, 110, draw.integers(20, 300)).astype(np.uint8)) for _ in range(200)]
    network = quality_cnn.fit([(t, 1) for t in clean] + [(spoiled(t), 0) for t in clean], {0: 200, 1: 200})
    held = [bytes(draw.integers(97, 110, 200).astype(np.uint8)) for _ in range(40)]
    long = held[0] * 200
    rows = [(i, t.decode()) for i, t in enumerate(held)] + [(100 + i, spoiled(t).decode()) for i, t in enumerate(held)]
    rows += [(199, long.decode()), (200, (long + spoiled(held[1])).decode()), (300, None), (301, ""), (None, "short")]
    scores = {r.doc_id: r.score for r in quality_cnn.score(spark.createDataFrame(rows, "doc_id long, text string"), network).collect()}
    right = sum(scores[i] > 0.5 for i in range(40)) + sum(scores[100 + i] < 0.5 for i in range(40))
    assert right >= 76 and scores[199] > 0.5 > scores[200]
    assert all(0 <= s <= 1 for s in scores.values()) and scores[300] == scores[301]


def test_gradients_match_differences():
    network = quality_cnn.Network.start(3)
    text = np.frombuffer(spoiled(b"some text of a few words"), np.uint8)
    grads = network.gradients(text, 1)
    for parameter, grad in zip(network.parameters(), grads):
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        old, losses = parameter[at], []
        for step in (0.01, -0.01):
            parameter[at] = old + step
            losses.append(-np.log(network.score(text)))
        parameter[at] = old
        assert grad[at] == pytest.approx((losses[0] - losses[1]) / 0.02, rel=0.05)


def test_chunks_leave_no_gap(monkeypatch):
    network = quality_cnn.Network.start(1)
    text = np.random.default_rng(1).integers(0, 256, 1000).astype(np.uint8)
    whole = network.maxima(quality_cnn.symbols_of(text))[0].max(axis=0)
    monkeypatch.setattr(quality_cnn, "CHUNK", 64)
    assert np.allclose(network.maxima(quality_cnn.symbols_of(text))[0].max(axis=0), whole, atol=1e-5)


def plain_score(network, text):
    """Chunk by chunk, place by place and filter by filter."""
    symbols = list(text) + [quality_cnn.NO_BYTE] * max(0, quality_cnn.WIDTH - len(text))
    n_places = len(symbols) - quality_cnn.WIDTH + 1
    best, sums, chunks = [0.0] * quality_cnn.FILTERS, [0.0] * quality_cnn.FILTERS, 0
    for start in range(0, n_places, quality_cnn.CHUNK):
        chunks += 1
        for f in range(quality_cnn.FILTERS):
            top = -math.inf
            for place in range(start, min(start + quality_cnn.CHUNK, n_places)):
                window = [v for b in symbols[place : place + quality_cnn.WIDTH] for v in network.vectors[b].tolist()]
                top = max(top, sum(a * b for a, b in zip(window, network.filters[:, f].tolist())))
            active = max(0.0, top + float(network.shift[f]))
            best[f], sums[f] = max(best[f], active), sums[f] + active
    inputs = best + [s / chunks for s in sums]
    return 1 / (1 + math.exp(-sum(a * b for a, b in zip(inputs, network.weights.tolist())) - float(network.bias[0])))


def test_scores_are_those_of_plain_loops(monkeypatch):
    monkeypatch.setattr(quality_cnn, "CHUNK", 16)
    network = quality_cnn.train([np.frombuffer(b"good words here", np.uint8), np.frombuffer(b"#$%&|<>#$%&", np.uint8)], [1, 0], epochs=2)
    for text in (b"", b"x", b"good words here", bytes(range(40)), "é漢 words $$".encode() * 2, b"a" * 33):
        assert abs(network.score(np.frombuffer(text, np.uint8)) - plain_score(network, text)) < 1e-4


def test_without_both_labels_scores_are_even(documents):
    assert quality_cnn.fit([(b"a", 1)], {1: 1}) is None
    assert {r.score for r in quality_cnn.score(documents, None).collect()} == {0.5}


# Mixing


def plain_targets(sizes, share=1.5, weights=(5, 2, 1)):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    budget, full, target = share * sum(sizes.values()), set(), {}
    while True:
        open_ = [s for s in names if s not in full]
        rest = budget - sum(2 * sizes[s] for s in full)
        level = rest / sum(weight[s] for s in open_) if open_ else 0
        over = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not over:
            return {s: 2 * sizes[s] if s in full else level * weight[s] for s in names}
        full |= over


def test_mix_meets_its_targets(rows, documents):
    mix = mixing.mixed(documents).collect()
    sizes = Counter()
    for r in mix:
        sizes[r.source] += r.size
    expected, taken = plain_targets(sizes), Counter()
    for r in mix:
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r.size and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(expected[r.source])
    assert all(abs(taken[s] - expected[s]) <= 1 for s in expected)
    assert sum(expected.values()) == pytest.approx(1.5 * sum(sizes.values()))
    assert Counter(mix) == Counter(mixing.mixed(documents.repartition(7)).collect())


def test_taken_documents_add_up(documents):
    plan, taken = mixing.mixed(documents), mixing.take(documents)
    assert taken.columns == documents.columns
    counts = lambda frame, column: {r[0]: r[1] for r in frame.groupBy("source").agg(F.sum(column)).collect() if r[1]}
    words = taken.withColumn("n", mixing.word_count(F.col("text")))
    assert counts(words, "n") == counts(plan, "taken")


# Suffix-array dedup


def test_repeated_bytes_go(rows, documents, monkeypatch):
    for width, gram, many in ((400, 160, 256), (90, 30, 2)):
        monkeypatch.setattr(suffix_dedup, "MANY_UNITS", many)
        monkeypatch.setattr(suffix_dedup, "BLOCK", 8)
        times = Counter(b[k : k + width] for _, t in rows for b in [(t or "").encode()] for k in range(len(b) - width + 1))
        expected = Counter()
        for i, t in rows:
            body = (t or "").encode()
            gone = np.zeros(len(body) + 1, bool)
            for k in range(len(body) - width + 1):
                if times[body[k : k + width]] > 1:
                    gone[k : k + width] = True
            kept = bytes(b for b, g in zip(body, gone) if not g)
            spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
            expected[i, len(body), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()] += 1
        assert collected(suffix_dedup.remove_repeats(documents, width, gram=gram)) == expected


def pieces_sorted(monkeypatch, documents):
    """The pieces that come to the suffix arrays, as a table, and the result."""
    given, sort = [], suffix_dedup.sorted_runs
    monkeypatch.setattr(suffix_dedup, "sorted_runs", lambda pieces, width: given.append(pieces) or sort(pieces, width))
    found = {r.doc_id: (r.n_bytes, r.n_removed) for r in suffix_dedup.remove_repeats(documents).collect()}
    return given[0], found


def test_copies_do_not_meet_in_one_task(spark, documents, monkeypatch):
    text = " ".join(f"word{i * i}" for i in range(150))
    rows = [(i, text) for i in range(400)] + [(400, text[:700] + " ends otherwise " + text[:300])]
    pieces, found = pieces_sorted(monkeypatch, spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    times = pieces.groupBy("grp", "anchor", "content", "base").count().agg(F.max("count")).first()[0]
    assert 0 < times <= 16
    assert all(found[i] == (len(text), len(text)) for i in range(400)) and found[400][1] == 700 + (text[:701][-1] == " ")


def test_a_common_passage_does_not_fill_one_suffix_array(spark, monkeypatch):
    passage = "".join(f"{i * i:x} " for i in range(100, 240))[:600]
    rows = [(i, hashlib.sha256(b"%d" % i).hexdigest() + passage + hashlib.md5(b"%d" % i).hexdigest() * 2) for i in range(1600)]
    pieces, found = pieces_sorted(monkeypatch, spark.createDataFrame(rows, "doc_id long, text string"))
    most = pieces.groupBy("grp").agg(F.sum(F.length("piece")).alias("n")).agg(F.max("n")).first()[0]
    assert (most or 0) <= 512 << 10
    # A byte or two at the edges may be the same by chance.
    assert len(found) == 1600 and all(n == 728 and 600 <= gone <= 616 for n, gone in found.values())


def test_counted_windows_give_the_same(documents, monkeypatch):
    for width, gram in ((400, 160), (90, 30)):
        expected = collected(suffix_dedup.remove_repeats(documents, width, gram=gram))
        with monkeypatch.context() as patch:
            patch.setattr(suffix_dedup, "GROUP_BYTES", 0)
            patch.setattr(suffix_dedup, "MANY_UNITS", 2)
            assert collected(suffix_dedup.remove_repeats(documents, width, gram=gram)) == expected


# Empty tables


def test_empty_tables_give_empty_results(spark, empty):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    examples, counts = quality_cnn.sample(empty, labels, F.lit(True), "text", "doc_id", "quality")
    results = [
        warc.write_and_read(spark, empty.withColumn("url", F.lit("")), "doc_id", "url", "text"),
        decontaminate.find_items(empty, benchmark),
        decontaminate.without_items(empty, benchmark),
        jaccard_join.join_similar(empty),
        jaccard_join.keep_first(empty),
        quality_rules.judge(empty),
        substring_dedup.remove_repeats(empty),
        token_counts.count_tokens(empty, tokenizer_file(), 1),
        token_files.write_and_read(spark, empty, tokenizer_file(), 2),
        quality_cnn.score(empty, quality_cnn.fit(examples, counts)),
        mixing.mixed(empty),
        mixing.take(empty),
        suffix_dedup.remove_repeats(empty),
    ]
    assert [r.count() for r in results] == [0] * len(results)
