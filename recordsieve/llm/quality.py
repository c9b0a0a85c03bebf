"""Quality: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader updates."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordsieve.llm import ftrl
from recordsieve.llm.text import mix, shapes, words

SETTINGS = ftrl.Settings(bits=20, passes=2, alpha=0.3, l1=1.0)
THRESHOLD = 0.7


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word n-grams: runs of 1, 2 and 3 words, and, to carry over to words never seen, of 1, 2 and 3 word shapes.

    A shape run also tells which of its words equal the one before, so that repetition shows.
    """
    hashes, counts = words(column)
    forms, same = words(shapes(column), lower=False)
    assert len(forms) == len(hashes) and (same == counts).all()
    n, ends = len(hashes), np.repeat(np.cumsum(counts), counts)
    place = np.arange(n)
    doc = np.repeat(np.arange(len(counts)), counts)
    again = np.zeros(n, np.uint64)
    again[1:] = hashes[1:] == hashes[:-1]
    found, owner = [], []
    for parts, salt in ((hashes, 0x9E6C63D0676A9A99), (forms, 0xC2B2AE3D27D4EB4F)):
        shape = parts is forms
        run = mix(parts) if shape else parts
        found.append(run)
        owner.append(doc)
        for gap in (1, 2):
            first = place[place + gap < ends]
            last = parts[first + gap] + again[first + gap] * np.uint64(shape)
            part = mix(run[first] * np.uint64(salt) + last)
            found.append(part)
            owner.append(doc[first])
            run = np.zeros(n, np.uint64)
            run[first] = part
    owner = np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(found)[order], np.bincount(owner, minlength=len(counts)).astype(np.int64)


def quality(
    docs: DataFrame, labelled: DataFrame, settings: ftrl.Settings = SETTINGS, texts: DataFrame | None = None
) -> DataFrame:
    """(doc_id, score, predicted) for every row of `docs` (doc_id, text, ...).

    `labelled` has (id, label) and `texts` (id, text); without `texts`, `labelled` has a column text itself. Label 1 is
    for good texts; all of them are used, see `ftrl.train`. Every copy of a row is scored. NULL and
    empty texts get the score of a text without features. Other columns are not read.
    """
    model = ftrl.train(labelled, labelled if texts is None else texts, features, settings)
    scored = ftrl.score(docs, model, features, settings.bits, F.col("text"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
