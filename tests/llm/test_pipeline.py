"""The whole pipeline against its stages' plain versions, and each stage's contract."""

import hashlib

import corpus_pipeline
import test_decontaminate as decontaminate
import test_minhash as minhash
import test_substring as substring
from tokenizers import Tokenizer

from tallyroll.llm.bpe import vocabulary_path
from tallyroll.llm.quality import quality_rules


def test_run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    # Quality: its own verdict, whose parts have their tests.
    kept = {r.doc_id for r in quality_rules(docs).filter("kept").collect()}
    texts = {i: t for i, t in texts.items() if i in kept}
    texts = {i: texts[i] for i, _, root in minhash.plain(list(texts.items())) if i == root}
    gone = {i: n for i, _, n, _ in substring.plain(list(texts.items()))}
    after = {}
    owner = {}
    for i in sorted(texts):
        words = substring.WORD.findall(texts[i])
        windows = [tuple(words[k : k + 13]) for k in range(len(words) - 12)]
        cut = {j for k, w in enumerate(windows) if owner.get(w, i) < i for j in range(k, k + 13)}
        for w in windows:
            owner.setdefault(w, i)
        assert len(cut) == gone[i]
        after[i] = " ".join(w for j, w in enumerate(words) if j not in cut) if cut else texts[i]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    seen = {i for i, t in after.items() if any(decontaminate.normal(p) in decontaminate.normal(t) for _, p in items)}
    library = Tokenizer.from_file(vocabulary_path())
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, sf_dir).collect()}
    # Documents that go beyond exact passages have one within the edit budget.
    more = set(after) - seen - set(got)
    assert all(decontaminate.plain([after[i]], items)[0] for i in more)
    assert set(got) == set(after) - seen - more and seen
    for i, r in got.items():
        ids = library.encode(after[i], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_stages_keep_the_columns_and_take_odd_tables(spark, tmp_path, sf_dir):
    rows = [(1, None, None, None, None), (None, "a b c", "en", "s", 5), (2, "", "de", None, 0), (3, "word " * 30, "en", "s", 150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "1 as cell", "2 as `id`")
    for table in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, table, sf_dir)
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
            assert out.count() <= table.count()
        assert corpus_pipeline.STAGES[-1][1](spark, table, sf_dir).count() == table.count()
