"""The pipeline against a plain version of all its stages."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import corpus_pipeline
from stewardry.llm.queries import tokenizer_file
from test_operators import plain_join, plain_targets
from test_texts import edit_distance_inside


def plain_words(text):
    return re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", text.lower())


def passes_rules(text):
    words = text.split()
    times = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    held = {j for k in range(len(words) - 2) if times[tuple(words[k : k + 3])] > 1 for j in range(k, k + 3)}
    return len(words) >= 50 and 100 * len(held) <= 50 * len(words)


def mixed(docs, sources):
    sizes = Counter()
    for i, text in docs:
        sizes[sources[i]] += len(text.split())
    targets, before, out = plain_targets(sizes), defaultdict(int), []
    for i, text in sorted(docs, key=lambda d: hashlib.md5(f"0|{d[0]}".encode()).hexdigest()[:16]):
        source, words = sources[i], text.split()
        goal = int(targets[source] + 0.5)
        epochs = goal // sizes[source]
        part = max(0, min(goal - epochs * sizes[source] - before[source], len(words)))
        before[source] += len(words)
        taken = epochs * len(words) + part
        out += [(i, text)] * (taken // len(words))
        if taken % len(words):
            out.append((i, " ".join(words[: taken % len(words)])))
    return out


def test_pipeline_does_what_its_stages_say(spark, tmp_path):
    from tokenizers import Tokenizer

    draw = random.Random(9)
    vocabulary = [f"{a}{b}{c}" for a in "bdkl" for b in "aeiou" for c in ("n", "st", "ring", "la", "mo", "tek")]
    text = lambda n: " ".join(draw.choices(vocabulary, k=n))
    docs = [(i, text(draw.randint(30, 140))) for i in range(60)]
    docs += [(100 + i, docs[i][1]) for i in range(8)]
    docs += [(200 + i, docs[10 + i][1] + " one more") for i in range(8)]
    docs += [(300, "again and again and again and again " * 30), (301, None), (302, "")]
    items = [(i, " ".join(docs[20 + i][1].split()[3:23])) for i in range(5)]
    sources = {i: ("a", "b", "c")[i % 3] for i, _ in docs}
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    frame = spark.createDataFrame([(i, t, "en", sources[i], len(t or "")) for i, t in docs], columns)
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    left = [(i, t) for i, t in docs if t and passes_rules(t)]
    first = {row[0] for row in plain_join(left) if row[0] == row[1]}
    left = [d for d in left if d[0] in first]
    sought = [plain_words(t) for _, t in items]
    left = [
        (i, t) for i, t in left
        if not any(edit_distance_inside(s, plain_words(t)) <= int(0.2 * len(s)) for s in sought)
    ]
    assert 0 < len(left) < len(first) < len(docs)
    library, expected, start = Tokenizer.from_file(tokenizer_file()), Counter(), 0
    for i, t in sorted(mixed(left, sources)):
        ids = library.encode(t, add_special_tokens=False).ids + [corpus_pipeline.END_ID]
        expected[i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
        start += len(ids)
    result = corpus_pipeline.run(spark, f"file://{tmp_path}")
    assert Counter(map(tuple, result.collect())) == expected


def test_all_stages_but_the_last_keep_the_columns(documents, spark, tmp_path):
    spark.createDataFrame([(1, "some words of an item")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, documents, f"file://{tmp_path}").columns == documents.columns, name


def test_an_empty_corpus_runs_through(empty, spark, tmp_path):
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"file://{tmp_path}").count() == 0
