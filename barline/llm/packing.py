"""Packing documents into sequences with a controlled mixture of sources.

Every source is a queue of shuffled documents. Windows of ``WINDOW`` tokens are filled
by deficit round-robin: a window adds ``share * WINDOW`` tokens to a source's deficit
and takes whole documents while the deficit pays for them; what is left over is carried
into the next window, over partitions as well. A document is therefore served in the
first window whose quanta so far cover the queue up to its end, which two running sums
give without visiting the windows one after the other. Windows are laid end to end and
cut into sequences of ``LENGTH`` tokens, so only the last sequence can need padding.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.llm.common import lookup, prefix_sums, text_of
from barline.plans import land

LENGTH = 2048
WINDOW = 64 * LENGTH
VOCABULARY = "word_bpe_49k.json"
END = 1
# Words whose ids a worker remembers: about 250 bytes each.
REMEMBERED = 300_000
_SOURCE = ["_none", "_source"]

# Bytes without a printable character of their own stand as characters from 256 on.
_HIDDEN = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b)]
_BYTE_CHARS = {b: 256 + i for i, b in enumerate(_HIDDEN)}


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordTokenizer:
    """Token ids of whole texts, equal to those of the tokenizer for the whole text.

    The tokenizer drops white space and no token spans it, so a text's ids are those of
    its words one after the other. Ids of frequent words are remembered. A word of
    letters is one piece for the merges, so the model takes it directly, its bytes as the
    characters that stand for them. A text with a character outside Latin-1 goes to the
    tokenizer as it is.
    """

    def __init__(self, path: str, end: int = END):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on every core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end = array("H", [end]).tobytes()
        self.known: dict[str, bytes] = {}

    def _encoded(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("H", x.ids).tobytes() for x in found]

    def _learn(self, unseen: set[str]) -> None:
        """Note the ids of unseen words. A final comma or full stop after a letter is a token
        of its own, so the word before it is looked up by itself."""
        known, tokens = self.known, self.tokenizer.model.tokenize
        tails, others, stems = [], [], set()
        for word in unseen:
            if word.isalpha():
                stems.add(word)
            elif word[-1] in ",." and word[-2:-1].isalpha():
                tails.append(word)
                others.append(word[-1])
                if word[:-1].isalpha():
                    stems.add(word[:-1])
                else:
                    others.append(word[:-1])
            else:
                others.append(word)
        for word in stems:
            if word not in known:
                # Letters of ASCII stand for themselves.
                spelt = word if word.isascii() else word.encode().decode("latin-1").translate(_BYTE_CHARS)
                known[word] = array("H", [x.id for x in tokens(spelt)]).tobytes()
        others = [word for word in dict.fromkeys(others) if word not in known]
        known.update(zip(others, self._encoded(others), strict=True))
        for word in tails:
            known[word] = known[word[:-1]] + known[word[-1]]

    def ids(self, texts: list[str]) -> list[bytes]:
        """For every text its ids as little-endian unsigned 16-bit numbers, and the end id."""
        out: list[bytes | None] = [None] * len(texts)
        split: list[tuple[int, list[str]]] = []
        words: set[str] = set()
        for i, text in enumerate(texts):
            # Special tokens are found before the text is cut into words, and some control
            # characters are white space for Python only.
            if not _latin(text) or "<|" in text or any(c in text for c in "\x1c\x1d\x1e\x1f"):
                out[i] = self._encoded([text])[0] + self.end
                continue
            found = text.lower().split()
            split.append((i, found))
            words.update(found)
        known, room = self.known, max(REMEMBERED, len(self.known))
        words.difference_update(known)
        if words:
            self._learn(words)
        for i, found in split:
            out[i] = b"".join(map(known.__getitem__, found)) + self.end
        while len(known) > room:  # the words learned last go
            known.popitem()
        return out


def _latin(text: str) -> bool:
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def token_table(docs: DataFrame, path: str | None = None, end: int = END) -> DataFrame:
    """One row per document: ``_row``, ``_id``, source, shuffle key, ``_n`` and ``_ids``."""
    path = path or vocabulary_path()

    def tokenised(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = WordTokenizer(path, end)
        for batch in batches:
            texts = batch.pop("_text").tolist()
            # A few texts at a time keeps the lists of words small.
            ids = [x for at in range(0, len(texts), 256) for x in tokenizer.ids(texts[at : at + 256])]
            yield batch.assign(_n=[len(x) // 2 for x in ids], _ids=ids)

    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        # As text: a batch of whole numbers with a null would come as doubles.
        F.col("doc_id").cast("bigint").cast("string").alias("_id"),
        F.col("source").isNull().alias("_none"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("_source"),
        F.xxhash64("doc_id", text_of()).alias("_shuffle"),
        text_of().alias("_text"),
    )
    schema = (
        "_row bigint, _id string, _none boolean, _source string, _shuffle bigint, "
        "_n bigint, _ids binary"
    )
    return land(rows.mapInPandas(tokenised, schema), "tokens")


def placed(
    sizes: DataFrame, shares: Mapping[str, float] | None = None, window: int = WINDOW
) -> DataFrame:
    """``_row`` with ``_at``, the first position of its document in the packed stream.

    A source without a share gets its part of all tokens, so that all queues end
    together; shares are relative to each other.
    """
    sources = prefix_sums(
        sizes.groupBy(*_SOURCE).agg(F.sum("_n").alias("_tokens")),
        _SOURCE,
        {"_upto": "_tokens"},
        "packing-sources",
    ).select(*_SOURCE, "_tokens", (F.col("_upto") - F.col("_tokens")).alias("_base"))
    total = sources.agg(F.sum("_tokens")).first()[0] or 1
    share = F.col("_tokens") / F.lit(float(total))
    for name, value in (shares or {}).items():
        share = F.when(~F.col("_none") & (F.col("_source") == name), F.lit(float(value))).otherwise(share)
    quanta = sources.withColumn("_quantum", share * F.lit(window))
    queue = prefix_sums(sizes, [*_SOURCE, "_shuffle", "_row"], {"_upto": "_n"}, "packing-queues")
    served = lookup(queue, quanta, _SOURCE, "_part").select(
        "_row",
        "_n",
        *_SOURCE,
        "_shuffle",
        F.ceil((F.col("_upto") - F.col("_base")) / F.col("_quantum")).alias("_window"),
    )
    order = ["_window", *_SOURCE, "_shuffle", "_row"]
    stream = prefix_sums(served, order, {"_end": "_n"}, "packing-stream")
    return stream.select("_row", (F.col("_end") - F.col("_n")).alias("_at"))


def packed(
    docs: DataFrame,
    path: str | None = None,
    length: int = LENGTH,
    window: int = WINDOW,
    shares: Mapping[str, float] | None = None,
    end: int = END,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A null or empty text is a document of the end id alone. A null source is a source of
    its own. Repeated rows are documents of their own. A document is cut only where a
    sequence is full. Sequences are numbered from 0 in the order of the windows. An
    empty table gives an empty result. Other columns are not looked at.
    """
    tokens = token_table(docs, path, end)
    where = placed(tokens.drop("_id", "_ids"), shares, window)

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, ids, at in zip(batch["_id"], batch["_ids"], batch["_at"], strict=True):
                wide = np.frombuffer(ids, "<u2").astype("<u4")
                start = 0
                while start < len(wide):
                    offset = (at + start) % length
                    stop = min(len(wide), start + length - offset)
                    crc = zlib.crc32(wide[start:stop].tobytes())
                    out.append(
                        (doc, start, stop - start, crc, len(wide), (at + start) // length, offset)
                    )
                    start = stop
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            frame = pd.DataFrame(out, columns=names)
            yield frame.astype({n: "object" if n == "doc_id" else "int64" for n in names})

    return (
        tokens.select("_row", "_id", "_ids")
        .join(where, "_row")
        .select("_id", "_ids", "_at")
        .mapInPandas(
            pieces,
            "doc_id string, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
            "sequence_id bigint, offset bigint",
        )
        .withColumn("doc_id", F.col("doc_id").cast("bigint"))
    )
