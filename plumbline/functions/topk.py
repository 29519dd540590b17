"""Best k per question, kept while blocks of scores pass through a task."""

from __future__ import annotations

import numpy as np

# Scores are compared at this many digits, so that equal rows tie whatever the order of their sums.
SCORE_DIGITS = 9


class BestK:
    """For each of n questions the k highest scores seen, ties broken by the smaller id. Memory is n × k."""

    def __init__(self, questions: int, k: int):
        self.k = k
        self.kept: list[tuple[np.ndarray, np.ndarray] | None] = [None] * questions

    def add(self, scores: np.ndarray, ids: np.ndarray, first: int = 0) -> None:
        """`scores` has one row per document and one column per question, from question `first` on; -inf means no match."""
        scores = np.round(scores, SCORE_DIGITS)
        n = len(ids)
        for q in range(first, first + scores.shape[1]):
            column = scores[:, q - first]
            found = np.flatnonzero(column > -np.inf)
            if n > self.k and len(found) > self.k:
                floor = np.partition(column, n - self.k)[n - self.k]
                found = np.flatnonzero((column >= floor) & (column > -np.inf))
            if not len(found):
                continue
            values, names = column[found], ids[found]
            if self.kept[q] is not None:
                values = np.concatenate([self.kept[q][0], values])
                names = np.concatenate([self.kept[q][1], names])
            by_id = np.argsort(names, kind="stable")
            order = by_id[np.argsort(-values[by_id], kind="stable")][: self.k]
            self.kept[q] = (values[order], names[order])

    def rows(self, question_ids: list) -> tuple[list, list, list]:
        questions, documents, scores = [], [], []
        for question, kept in zip(question_ids, self.kept, strict=True):
            if kept is not None:
                questions.extend([question] * len(kept[0]))
                documents.extend(kept[1].tolist())
                scores.extend(kept[0].tolist())
        return questions, documents, scores
