"""Token files of texts that hold added tokens, against a plainly loaded tokenizer."""

import zlib

import numpy as np
import public_tokenizers

from rowgate.llm import queries

TEXTS = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y z", "plain words only", "a  <|endoftext|>", "<|endoftext|> <|endoftext|> c", None]


def test_query_gives_the_library_s_ids(spark, tmp_path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op3_token_files(spark, str(tmp_path)).orderBy("doc_id").collect()
    at = 0
    for row, text in zip(got, TEXTS, strict=True):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        assert (row.start, row.n_tokens, row.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert 50256 in library.encode(TEXTS[0], add_special_tokens=False).ids
