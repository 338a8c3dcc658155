"""A bounded copy that can be stopped and run again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import fs
from ..plans.time_range import TimeRange
from .store import TableStore


def copy_slices(
    source: DataFrame | TableStore,
    time_range: TimeRange,
    target: TableStore,
    job: str,
    windows_at_once: int | None = None,
) -> list[tuple[int, int]]:
    """Copy the range window by window, each as one batch of the target.

    All windows that are not committed yet are written by one job, which reads the source once; with
    ``windows_at_once`` a job takes so many, so that a long copy is committed in steps. A job that
    breaks off is run again on the first half of its windows and so on: the windows before the one
    that breaks are committed, and the error is raised. Windows that are committed are not read again,
    and from a stored table a job reads only the folders of its time. Returns the windows this
    call copied. The bounds belong to the job: with others its windows would overlap those it has
    copied, so that is an error.
    """
    described = f"{target.path}/jobs/{job}.json"
    plan = {"column": time_range.column, "start": time_range.start_ms, "end": time_range.end_ms, "step": time_range.step_ms}
    if not fs.exists(target.spark, described):
        fs.write_json(target.spark, described, plan)
    elif fs.read_json(target.spark, described) != plan:
        raise ValueError(f"copy {job!r} was begun with other bounds")

    def batch(window: tuple[int, int]) -> str:
        return f"{job}-{window[0]}-{window[1]}"

    def write(windows: list[tuple[int, int]]) -> None:
        rows = window_rows(source, time_range, windows)
        target.append_batches(rows, _batch_of(rows, time_range, windows, job), [batch(w) for w in windows])
        copied.extend(windows)

    def write_or_halve(windows: list[tuple[int, int]]) -> None:
        try:
            write(windows)
        except Exception:
            if len(windows) == 1:
                raise
            middle = len(windows) // 2
            write_or_halve(windows[:middle])
            write_or_halve(windows[middle:])

    copied: list[tuple[int, int]] = []
    done = target.committed_batches()
    missing = [w for w in time_range.windows() if batch(w) not in done]
    step = windows_at_once or max(1, len(missing))
    for at in range(0, len(missing), step):
        write_or_halve(missing[at : at + step])
    return copied


def window_rows(source: DataFrame | TableStore, time_range: TimeRange, windows: list[tuple[int, int]]) -> DataFrame:
    """The source's rows from the first of some windows to the last, in one scan."""
    span = time_range.window(windows[0][0], windows[-1][1])
    rows = source.read(span.start, span.end) if isinstance(source, TableStore) else source
    return rows.where(span.contains(rows.schema[span.name].dataType))


def _batch_of(rows: DataFrame, time_range: TimeRange, windows: list[tuple[int, int]], job: str) -> Column:
    """The batch of each row: its window's. NULL in a window that is not listed."""
    index = time_range.window_index(rows.schema[time_range.name].dataType)
    start = F.lit(time_range.start_ms) + index * time_range.step_ms
    end = F.least(start + time_range.step_ms, F.lit(time_range.end_ms))
    batch = F.concat_ws("-", F.lit(job), start.cast("string"), end.cast("string"))
    numbers = [(w[0] - time_range.start_ms) // time_range.step_ms for w in windows]
    between = len(numbers) == numbers[-1] - numbers[0] + 1
    return batch if between else F.when(index.isin(numbers), batch)
