from collections import defaultdict

import corpus_pipeline
import public_tokenizers
import pyarrow as pa
from __spark_entry__ import queries
from test_exact_dedup import FOLD
from test_simhash import brute
from tokenizers import Tokenizer

from ordermill.llm import secret_scan, toxicity
from ordermill.llm.common import SpanHasher


def copies(spark, sf_dir, tmp_path, extra):
    """The documents with more rows, beside the labels, in a folder of their own."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    more = spark.createDataFrame(extra, docs.schema)
    docs.union(more).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{sf_dir}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_stages_match_brute_force(spark, sf_dir, tmp_path):
    words = " ".join(f"clean{i} plain{i}" for i in range(200))
    key = "aB3dE6gH9jK2mN5pQ8sT1vW4yZ7+cD0f"
    extra = [(900001 + i, words if i % 2 else words.upper(), "en", "s", 1) for i in range(5)]
    extra += [(910001, f"{words} one", "en", "s", 2), (910002, f"the key {key} here", None, None, None)]
    extra += [(920001, None, "en", "s", 0), (920002, "", "en", None, None), (None, "x y", "en", "s", 3)]
    folder = copies(spark, sf_dir, tmp_path, extra)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    rows = [tuple(r) for r in docs.collect()]

    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = toxicity.fit(docs, labels)
    raw = pa.array([(r[1] or "").encode() for r in rows], pa.large_binary())
    clean = toxicity.score_batch(model, SpanHasher(), raw)[0] < toxicity.THRESHOLD
    rows = [r for r, good in zip(rows, clean, strict=True) if good]

    groups = defaultdict(list)
    for r in rows:
        groups[(r[1] or "").translate(FOLD)].append(r)
    rows = [max(g, key=lambda r: -1 if r[0] is None else r[0]) for g in groups.values()]

    kept = {(i, part) for i, _, part in brute([(r[0], r[1]) for r in rows])}
    rows = [r for r in rows if (r[0], r[0]) in kept]

    masked = []
    for i, text, lang, source, n in rows:
        new = secret_scan.masked(text, secret_scan.find_spans(text)[1]) if text else text
        masked.append((i, new, lang, source, len(new) if new and secret_scan.MASK in new else n))
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))

    found = docs
    steps = {}
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, found, folder)
        steps[name] = found
        if name != "best_fit_packing":
            assert found.columns == columns
    assert sorted(map(repr, map(tuple, steps["secret_scans"].collect()))) == sorted(map(repr, masked))

    packed = corpus_pipeline.run(spark, folder).collect()
    lengths = defaultdict(int)
    for r in packed:
        lengths[r.doc_id] += r.length
    assert lengths == {
        i: len(library.encode(t or "", add_special_tokens=False).ids) + 1 for i, t, *_ in masked
    }


def test_pipeline_is_registered_and_its_stages_named():
    assert queries()["pipeline"] is corpus_pipeline.run
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "simhash_near_dedup", "secret_scans", "best_fit_packing"]
