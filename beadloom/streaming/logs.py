"""Error blocks of run logs as their lines arrive: a block is given out when it ends, whatever micro-batch that is in.

The state per log is its open block and how many there were before, which the checkpoint keeps over restarts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.qc import FINISHED, JOBID, LOG, RULE

BLOCK = "block long, line_no long, rule string, jobid string, log string"
STATE = "blocks long, is_open boolean, line_no long, rule string, jobid string, log string, last long"


def error_blocks(lines: DataFrame, by: str) -> DataFrame:
    """Blocks (by, block, line_no, rule, jobid, log) of a stream of lines (by, line_no, line).

    Within a log lines have to come in the order of line_no, those of one micro-batch in any order; one that comes behind
    later ones is an error. A null line stands for the log's end, which ends an open block; nothing else can tell.
    """
    rule, jobid, log = (re.compile(p) for p in (RULE, JOBID, LOG))

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        blocks, is_open, at, name, job, path, last = state.get if state.exists else (0, False, 0, None, None, None, None)
        out = []
        rows = pd.concat(list(frames)).sort_values("line_no", kind="stable")  # a log's lines of one micro-batch
        if last is not None and len(rows) and rows["line_no"].iloc[0] <= last:
            raise ValueError(f"{key[0]}: line {rows['line_no'].iloc[0]} comes behind line {last}")
        for no, line in zip(rows["line_no"].tolist(), rows["line"].tolist()):
            last = no
            text = None if line is None or line != line else line
            start = rule.search(text) if text is not None else None
            if start:
                if is_open:
                    out.append((blocks, at, name, job, path))
                blocks, is_open, at, name, job, path = blocks + 1, True, no, start.group(1), None, None
            if not is_open:
                continue
            if text is None:
                found = None
            elif found := jobid.search(text):
                job = found.group(1)
            elif found := log.search(text):
                path = found.group(1)
            if not start and not found and (text is None or not text.strip(" ") or FINISHED in text):
                out.append((blocks, at, name, job, path))
                is_open = False
        state.update((blocks, is_open, at, name, job, path, last))
        yield pd.DataFrame([(key[0], *r) for r in out], columns=[by, "block", "line_no", "rule", "jobid", "log"])

    kind = lines.schema[by].dataType.simpleString()
    return lines.groupBy(by).applyInPandasWithState(run, f"{by} {kind}, {BLOCK}", STATE, "append", GroupStateTimeout.NoTimeout)
