"""Token counts of whole texts under a published subword vocabulary, by a compiled transducer.

The vocabulary file names the pieces and their scores; the counting is done by
``transducer``. Null and empty texts have no tokens. A character outside the vocabulary
counts as its UTF-8 bytes, and a control string such as ``<s>`` inside a text is ordinary
text. Null ids, repeated rows and ties are rows like any other, other columns are left
aside, an empty table gives no rows. Each text is read where it lies: nothing is shuffled.
Memory of a task follows a batch of about two million characters; a longer text is cut
where no piece covers the cut, and stays whole only where it has no such place.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagedater.llm import transducer
from pagedater.llm.common import picked
from pagedater.llm.subword_ids import vocabulary_path

VOCABULARY = "piece_bpe_32k.model"
LIMIT = 4096
#: Characters that are read together.
TOGETHER = 1 << 20

#: How the vocabulary must treat white space and wide letters; others would need another reading.
PROBES = {" a  b ": "▁▁a▁▁b▁", "Ａ\t　ﬁ\n": "▁Ａ\t　ﬁ\n"}

COUNTED = "doc_id long, n_bytes long, n_tokens long"

_COUNTERS: dict[str, transducer.Counter] = {}


def piece_scores(path: str) -> dict[str, float]:
    """Pieces and scores of a merging vocabulary; refused if it rewrites texts before merging."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    if any(model.normalize(text) != shown for text, shown in PROBES.items()):
        raise ValueError(f"{path} rewrites texts")
    special = (model.is_byte, model.is_control, model.is_unknown, model.is_unused)
    ids = [i for i in range(model.get_piece_size()) if not any(kind(i) for kind in special)]
    return {model.id_to_piece(i): model.get_score(i) for i in ids}


def counter(path: str) -> transducer.Counter:
    """The compiled transducer of a vocabulary file, one in each Python worker."""
    if path not in _COUNTERS:
        _COUNTERS[path] = transducer.Counter(piece_scores(path))
    return _COUNTERS[path]


def _counted(texts: list[str | None], counts: transducer.Counter) -> list[int]:
    """Tokens of every text; parts of long ones are added up."""
    found = [0] * len(texts)
    owners, parts, size = [], [], 0
    for i, text in enumerate(texts):
        for part in counts.parts(transducer.MARK + text) if text else ():
            owners.append(i)
            parts.append(part)
            size += len(part)
            if size >= TOGETHER:
                for owner, n in zip(owners, counts.counts(parts)):
                    found[owner] += n
                owners, parts, size = [], [], 0
    for owner, n in zip(owners, counts.counts(parts) if parts else ()):
        found[owner] += n
    return found


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = LIMIT) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` for every row of ``docs``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counter(vocabulary_path(vocabulary))
        for batch in batches:
            tokens = _counted(batch.column(2).to_pylist(), counts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(tokens, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"]
            )

    read = picked(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "text",
    )
    return read.mapInArrow(count, COUNTED).withColumn("over_limit", F.col("n_tokens") > limit)
