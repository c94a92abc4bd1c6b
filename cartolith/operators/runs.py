"""Sequential selections within groups, many groups a task."""

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


def chosen(rows: DataFrame, keys: list[str], order: list, choose: Callable[[dict[str, np.ndarray]], list[int]]) -> DataFrame:
    """The rows that `choose` picks from each group, given its columns in `order`.

    A task goes through its sorted groups in one pass and holds one group at a time, so small
    groups by the thousand cost no call each.
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []  # of the last group, joined when it is whole

        def picked(pdf: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
            cols, keep = {c: pdf[c].to_numpy() for c in pdf.columns}, []
            for a, b in zip(starts, [*starts[1:], len(pdf)], strict=True):
                keep += [a + n for n in choose({c: v[a:b] for c, v in cols.items()})]
            return pdf.iloc[keep]

        for pdf in batches:
            if not len(pdf):
                continue
            if held and (pdf[keys].iloc[[0, -1]].to_numpy() == held[0][keys].iloc[0].to_numpy()).all():
                held.append(pdf)  # sorted: what lies between is of the group, too
                continue
            pdf = pd.concat([*held, pdf], ignore_index=True)
            new = (pdf[keys] != pdf[keys].shift()).any(axis=1).to_numpy()
            starts = np.flatnonzero(new)
            held = [pdf.iloc[starts[-1] :].reset_index(drop=True)]
            if len(starts) > 1:
                yield picked(pdf.iloc[: starts[-1]], starts[:-1])
        if held:
            yield picked(pd.concat(held, ignore_index=True), np.array([0]))

    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInPandas(work, rows.schema)
