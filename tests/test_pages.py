"""Pages against a loop that adds up block by block."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomspark.operators.filters import Filter
from loomspark.operators.order import reduce_pages
from loomspark.plans.pages import COUNTS, cut, page_log, run_pages
from loomspark.plans.query import ChainQuery
from test_streams import H, full


def plain(rows: dict, limits: list, start: int, end: int) -> list[tuple]:
    out, at, held = [], start, [0] * 4
    for n in range(start, end):
        held = [a + b for a, b in zip(held, rows.get(n, [0] * 4), strict=True)]
        if any(limit is not None and h >= limit for h, limit in zip(held, limits, strict=True)):
            out.append((at, n + 1, *held))
            at, held = n + 1, [0] * 4
    return [*out, (at, end, *held)] if at < end else out


@pytest.mark.parametrize("seed", range(6))
def test_cut_over_steps(seed):
    draw = random.Random(seed)
    rows = {n: [1, draw.randrange(4), draw.randrange(9), draw.randrange(3)] for n in range(10, 400) if draw.random() < 0.7}
    rows[50] = [1, 900, 5, 1]  # beyond a limit by itself
    limits = [draw.choice((None, 1, 17)), draw.choice((None, 9, 40)), draw.choice((None, 25)), None]
    got, start, held = [], 5, [0] * 4
    for low in range(5, 420, 60):
        own = sorted(n for n in rows if low <= n < low + 60)
        *closed, open_ = cut(np.array(own, np.int64), np.array([rows[n] for n in own], np.int64).reshape(-1, 4), limits, start, held)
        got += [(a, b, *c) for a, b, c in closed]
        start, held = open_[0], open_[2]
    got = [*got, (start, 425, *held)] if start < 425 else got
    assert got == plain(rows, limits, 5, 425)


@pytest.fixture(scope="module")
def tables(spark):
    draw = random.Random(4)
    logs = [{"block_number": n, "transaction_hash": H(f"t{n}"), "log_index": i, "block_hash": H(n), "address": H(n % 2)[:20]} for n in range(60) for i in range(draw.randrange(5))]
    txs = [{"block_number": n, "hash": H(f"t{n}"), "transaction_index": 0} for n in range(60)]
    traces = [{"block_number": n, "transaction_hash": H(f"t{n}"), "type": "call"} for n in range(60)]
    blocks = [{"number": n, "hash": H(n)} for n in range(60)]
    return {"blocks": full(spark, "blocks", blocks), "transactions": full(spark, "transactions", txs), "logs": full(spark, "logs", logs), "traces": full(spark, "traces", traces)}


QUERY = ChainQuery(3).where("logs", Filter("logs").where("address", [H(1)[:20]])).select("logs", ["block_number", "log_index"])


def test_log_of_pages(spark, tables):
    query = QUERY.limit(logs=7, transactions=4)
    logs = tables["logs"].where(query.predicates()["logs"]).groupBy("block_number").count().collect()
    rows = {n: [1, 1, c, 1] for n, c in logs if n >= 3}
    got = sorted(tuple(r) for r in page_log(query, tables, step=13).collect())
    assert got == plain(rows, [None, 4, 7, None], 3, 60)
    assert [tuple(r)[:2] for r in page_log(QUERY, tables).collect()] == [(3, 60)]
    none = {t: df.limit(0) for t, df in tables.items()}
    assert page_log(query, none).count() == run_pages(query, none, lambda *_: 1 / 0).count() == 0
    with pytest.raises(ValueError):
        page_log(QUERY.limit(logs=0), tables)


def test_loop_over_pages_and_its_fold(spark, tables):
    seen = []
    log = run_pages(QUERY.limit(logs=20), tables, lambda page, result: seen.append((page.from_block, page.next_block, sorted(map(tuple, result.tables["logs"].collect())))))
    whole = sorted(map(tuple, QUERY.execute(tables).tables["logs"].collect()))
    assert [r for _, _, rows in seen for r in rows] == whole and len(seen) > 2
    assert [a for a, _, _ in seen[1:]] == [b for _, b, _ in seen[:-1]] and seen[-1][1] == 60
    folded = reduce_pages(log).first()
    assert (folded.archive_height, folded.next_block) == (59, 60) and folded.total_execution_time >= len(seen)
    assert log.agg(F.sum(COUNTS[2])).first()[0] == len(whole)
