"""Toxicity: FTRL-proximal logistic regression over hashed words, word pairs and skip-grams."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordsieve.llm import ftrl
from recordsieve.llm.text import NOT_ALNUM, mix, words

SETTINGS = ftrl.Settings(bits=20, passes=4, alpha=10.0, l1=4.0, l2=0.0)
THRESHOLD = 0.7


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Words without punctuation and case, pairs of neighbours, and pairs with one word between (2 and 3 in reach)."""
    hashes, counts = words(column, NOT_ALNUM)
    n, ends = len(hashes), np.repeat(np.cumsum(counts), counts)
    place = np.arange(n)
    doc = np.repeat(np.arange(len(counts)), counts)
    found, owner = [hashes], [doc]
    for gap, salt in ((1, 0x9E6C63D0676A9A99), (2, 0xC2B2AE3D27D4EB4F)):
        first = place[place + gap < ends]
        found.append(mix(hashes[first] * np.uint64(salt) + hashes[first + gap]))
        owner.append(doc[first])
    owner = np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(found)[order], np.bincount(owner, minlength=len(counts)).astype(np.int64)


def toxicity(
    docs: DataFrame, labelled: DataFrame, settings: ftrl.Settings = SETTINGS, texts: DataFrame | None = None
) -> DataFrame:
    """(doc_id, score, predicted) for every row of `docs` (doc_id, text, ...).

    `labelled` has (id, label) and `texts` (id, text); without `texts`, `labelled` has a column text itself. Label 1 is
    for toxic texts; all of them are used, see `ftrl.train`. Every copy of a row is scored. NULL and
    empty texts get the score of a text without features. Other columns are not read.
    """
    model = ftrl.train(labelled, labelled if texts is None else texts, features, settings)
    scored = ftrl.score(docs, model, features, settings.bits, F.col("text"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
