import os

import corpus_pipeline
import __spark_entry__
from shelfcast.llm import jaccard, quality, queries
from shelfcast.llm.common import read
from tests.llm.test_jaccard import brute as brute_classes
from tests.llm.test_lines import brute as brute_lines
from tests.llm.test_tiling import brute as brute_contaminated

NAMES = ["op1_extraction", "op2_token_counts", "op3_pii", "op4_warc", "op5_jaccard", "op6_bpe", "op7_quality", "op8_line_dedup", "op9_secrets", "op10_decontamination"]


def test_registered():
    registered = __spark_entry__.queries()
    assert set(NAMES) | {"pipeline"} <= set(registered) and set(queries.ORACLE_SQL) <= set(queries.QUERIES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "jaccard_dedup", "decontamination", "bpe_encoding"]


def test_nothing_else_imports_the_subpackage():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for folder, _, names in os.walk(os.path.join(root, "shelfcast")):
        for name in names:
            if name.endswith(".py") and os.path.basename(folder) != "llm":
                with open(os.path.join(folder, name)) as f:
                    assert "shelfcast.llm" not in f.read()


def test_stages_against_brute_force(spark, sf_small):
    docs = read(spark, sf_small, "documents")
    forest = quality.train(docs, read(spark, sf_small, "labels"))
    rows = [r for r in docs.collect()]

    def keeps(t):
        import numpy as np

        s = np.array([quality.statistics(t)])
        return s[0, 0] >= 20 and 100 * s[0, 4] <= 30 * s[0, 0] and (forest is None or forest.keeps(quality.features(s))[0])

    kept = [(r["doc_id"], r["text"]) for r in rows if keeps(r["text"])]
    kept = [(i, t) for i, t, *_ in brute_lines(kept)]
    classes = {eval(x)[0]: eval(x)[1] for x in brute_classes(kept)}  # noqa: S307  own tuples
    kept = [(i, t) for i, t in kept if classes[i] == i]
    dirty = {d for d, *_ in brute_contaminated(kept, [(r["item_id"], r["text"]) for r in read(spark, sf_small, "benchmark").collect()])}
    kept = [i for i, _ in kept if i not in dirty]
    got = corpus_pipeline.run(spark, sf_small)
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(kept) and kept


def test_repeated_rows_and_missing_ids(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text, "en", "s", 1), (1, text, "en", "s", 1), (2, text, "en", "s", 1), (None, text, None, None, None), (None, text, None, None, None), (None, None, None, None, None)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.jaccard_dedup(spark, d, "")
    assert out.columns == corpus_pipeline.COLUMNS and sorted((r["doc_id"] or 0, r["text"] or "") for r in out.collect()) == [(0, ""), (0, text), (1, text)]
    assert jaccard.similar(d).count() == 6
