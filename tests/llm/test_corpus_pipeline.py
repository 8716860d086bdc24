import subprocess
import sys
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
from conftest_llm import linked_components, shingles, table_rows
from test_decontaminate import brute

import corpus_pipeline
from lumenfit.llm import queries, token_store

ROOT = Path(__file__).parents[2]


def test_stages_against_brute_force(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    schema, names, before = docs.schema, [n for n, _ in corpus_pipeline.STAGES], None
    assert len(names) == 5 and corpus_pipeline.ORACLE_SQL is None
    for name, stage in corpus_pipeline.STAGES:
        before = docs.toPandas()
        stage(spark, docs, sf).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        after = docs.toPandas()
        rows = list(zip(before["doc_id"], before["text"]))
        if name != "token_ids":
            assert docs.columns == [f.name for f in schema]
        if name == "quality":
            good = {r["doc_id"] for r in queries.op2_quality(spark, sf).collect() if r["predicted"]}
            assert set(after["doc_id"]) == good and len(after) == len(good)
        elif name == "near_duplicates":
            keys = linked_components([(k, shingles(t, 5)) for k, t in rows], 80)
            assert sorted(after["doc_id"]) == sorted(k for (k, t), c in zip(rows, keys) if k == c)
        elif name == "decontamination":
            hits = brute(rows, [(r["item_id"], r["text"]) for r in table_rows(sf, "benchmark")])
            assert sorted(after["doc_id"]) == sorted(k for k, h in hits.items() if not h[4])
        elif name == "mixing":
            assert after["doc_id"].value_counts().max() <= 3 and set(after["doc_id"]) <= set(before["doc_id"])
            size = lambda t: len((t or "").split())
            assert abs(after["text"].map(size).sum() / before["text"].map(size).sum() - 1) < 0.05
        else:
            from tokenizers import Tokenizer

            tokenizer, start = Tokenizer.from_file(queries.tokenizer_path()), 0
            texts = dict(rows)
            after = after.sort_values("start")
            assert len(after) == len(before) and after["doc_id"].is_monotonic_increasing
            for _, r in after.iterrows():
                assert (r["start"], r["n_tokens"]) == (start, len(tokenizer.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids) + 1)
                start += r["n_tokens"]
    assert token_store.END == 2 and np.isfinite(start) and pq.ParquetDataset(f"{tmp_path}/quality")


def test_the_rest_works_without_the_subpackage():
    """With the folders and the pipeline out of reach the entry still imports and keeps every other query."""
    code = ("import sys; sys.modules['lumenfit.llm'] = None; sys.modules['corpus_pipeline'] = None\n"
            "import __spark_entry__ as e; q = e.queries(); assert len(q) > 50 and not any(k.startswith('op') and k[2].isdigit() for k in q) and 'pipeline' not in q; e.oracle_sql()")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
