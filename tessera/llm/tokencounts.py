"""Token counts by prefix dynamic programming.

The count of a text is the running sum of its pre-tokens' counts, and the
count of every pre-token's prefix comes from the table of ``wordbpe``; so the
exact count at every prefix of the normalised text is known, and budget and
truncation questions are look-ups that encode nothing again.

Defined results: null text counts as empty (0 tokens); special strings inside a text count as one
token, as the library's default has it; repeated rows and ids are separate rows; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import as_column, bounded_batches, byte_view
from tessera.llm.wordbpe import WordBpe, tokenizer

LIMIT = 2048


class PrefixTable:
    """Exact token counts at every prefix of one normalised text."""

    def __init__(self, bpe: WordBpe, text: str):
        self.bpe, self.text = bpe, bpe.normalised(text)
        _, self.head, self.tail, self.run, total = bpe.token_counts([text])
        self.total = int(total[0])

    def at(self, position: int) -> int:
        """Tokens of the first ``position`` code points."""
        k = int(np.searchsorted(self.tail, position, side="right"))
        done = int(self.run[k - 1]) if k else 0
        if k < len(self.head) and self.head[k] < position:
            return done + self._inside(k, position)
        return done

    def _inside(self, k: int, position: int) -> int:
        """Tokens of a cut pre-token: what is left of it may fall apart into
        several, as a cut contraction does."""
        part = self.text[self.head[k]:position]
        return int(self.bpe.token_counts([part])[4][0])

    def longest_within(self, budget: int) -> int:
        """Code points of the longest prefix of at most ``budget`` tokens."""
        k = int(np.searchsorted(self.run, budget, side="right"))
        if k == len(self.head):
            return len(self.text)
        best = int(self.head[k])
        # inside one pre-token counts need not rise step by step: look at all
        for position in range(int(self.tail[k]) - 1, int(self.head[k]), -1):
            if self.at(position) <= budget:
                return position
        return best


def counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit, fit_chars`` of every row;
    ``fit_chars``: code points of the normalised text that end with the last whole
    pre-token within ``limit``, read from the running counts."""
    bounded_batches(docs.sparkSession)

    def run(batches):
        bpe = tokenizer(path)
        for b in batches:
            arr = as_column(b, "text")
            _, off = byte_view(arr)
            doc, head, tail, total, n = bpe.token_counts([t or "" for t in arr.to_pylist()])
            inside = total <= limit
            fit = np.zeros(len(n), np.int64)
            np.maximum.at(fit, doc[inside], tail[inside])
            yield pa.RecordBatch.from_arrays(
                [as_column(b, "doc_id"), pa.array(np.diff(off)), pa.array(n), pa.array(n > limit), pa.array(fit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars"])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return src.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long")
