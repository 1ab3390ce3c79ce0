"""Token counts of texts by a public tokenizer, whose vocabulary file is a parameter."""

from __future__ import annotations

import base64
import re
from pathlib import PurePosixPath

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusmill.session import widened

#: Fixed value: the published splitting pattern of the rank files.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
_LOADED: dict[str, object] = {}


def encoder(path: str):
    """A function from a list of texts to their token counts by a vocabulary file, which is read as
    data; loaded once per worker."""
    key, vocabulary = path, PurePosixPath(path).name
    if key not in _LOADED:
        if vocabulary.endswith(".tiktoken"):
            import tiktoken

            with open(key, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            enc = tiktoken.Encoding(re.sub(r"\W", "_", vocabulary), pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
            _LOADED[key] = lambda texts: [len(enc.encode_ordinary(t)) for t in texts]
        elif vocabulary.endswith(".model"):
            import sentencepiece

            sp = sentencepiece.SentencePieceProcessor(model_file=key)
            _LOADED[key] = lambda texts: [len(x) for x in sp.encode(texts, num_threads=1)]
        else:
            from tokenizers import Tokenizer

            tok = Tokenizer.from_file(key)
            tok.encode_special_tokens = True
            _LOADED[key] = lambda texts: [len(x.ids) for x in tok.encode_batch(texts, add_special_tokens=False)]
    return _LOADED[key]


def with_tokens(docs: DataFrame, keep: list[str], vocabulary: str, text: str = "text") -> DataFrame:
    """The kept columns and n_tokens by the vocabulary file, which is shipped to the executors; null
    texts have 0 tokens, lone surrogates are replaced."""
    fields = {f.name: f.dataType.simpleString() for f in docs.schema}
    docs.sparkSession.sparkContext.addFile(vocabulary)
    name = PurePosixPath(vocabulary).name

    def run(batches):
        count = encoder(SparkFiles.get(name))
        for b in batches:
            texts = [(t or "").encode("utf-8", "replace").decode() for t in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(count(texts), pa.int64())], names=[*keep, "n_tokens"])

    return widened(docs.select(*keep, F.col(text).cast("string"))).mapInArrow(run, ", ".join(f"`{c}` {fields[c]}" for c in keep) + ", n_tokens bigint")
