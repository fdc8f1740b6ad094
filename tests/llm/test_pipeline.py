"""The pipeline's stages on a small table, each against a plain version."""

import numpy as np
import public_tokenizers as P
import test_jaccard
from tokenizers import Tokenizer

import corpus_pipeline
from filing_jobs.llm import pii


def test_stages(spark, tmp_path):
    rows = [(i, t, "en" if t else None, "s", len(t or "")) for i, t in test_jaccard.corpus(3)[:120]]
    rows.append((500, "write to bosbt.42@mail8.example.com or call +1 (988) 555-2485 about the words of b", "en", "s", 1))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    docs = [df]
    for _, stage in corpus_pipeline.STAGES:
        docs.append(stage(spark, docs[-1], str(tmp_path)).cache())
    assert all(d.columns == corpus_pipeline.COLUMNS for d in docs[1:4])
    text = [{r["doc_id"]: r["text"] for r in d.collect()} for d in docs[:4]]
    assert text[1] == {i: t for i, t in text[0].items() if (t or "").strip()}
    groups = test_jaccard.brute(list(text[1].items()))
    assert text[2] == {i: t for i, t in text[1].items() if groups[i][1] == i}
    cipher = pii.Feistel(pii.session_key(spark))
    assert text[3] == {i: pii.pseudonymise(t, cipher)[0] for i, t in text[2].items()} and "bosbt.42" not in text[3][500]
    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    ids = {}
    for r in sorted(docs[4].collect(), key=lambda r: r["start"]):
        ids.setdefault(r["doc_id"], []).extend(np.frombuffer(r["ids"], "<u4").tolist())
    assert ids == {i: library.encode(t, add_special_tokens=False).ids + [1] for i, t in text[3].items()}
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == docs[4].count()


def test_no_documents_give_no_pieces(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
