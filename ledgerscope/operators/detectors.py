"""Typology detectors: smurfing, round trips, rapid movement, trade-based
laundering, fan-out / fan-in, near-threshold amounts, rule risk score.

Skew: an account may carry a third of all rows, in one week as well. Rolling windows
and as-of lookups therefore don't group by account: rows are range-sorted by
(account, time) and scanned, and what crosses a partition border is one row a
partition. Interval joins use an equi key (account, time bucket) plus the exact
residual predicate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerscope.functions.constants import JURISDICTION_BASE_RISK, SAR_THRESHOLD_USD
from ledgerscope.functions.money import ratio_dp, round_hu, sum_usd
from ledgerscope.operators.prefix import prefix_sums
from ledgerscope.session import cut_lineage, passing_cuts

DAY = 86400
HOUR = 3600


def _sec(ts: str = "timestamp"):
    return F.unix_timestamp(F.col(ts))


def smurfing_windows(
    txns: DataFrame,
    threshold_usd: float = SAR_THRESHOLD_USD,
    window_hours: int = 56,
    min_count: int = 5,
) -> DataFrame:
    """Rows at which a sender has >= min_count sub-threshold transfers inside
    the trailing ``window_hours`` (equal seconds count together), with the window's
    total. Each second's transfers are added at their time and taken off when they
    leave the window, so running sums in (sender, time) order are the windows: a
    sender's own events cancel out, and no sender's rows have to meet in a task."""
    lim = int(round(threshold_usd * 100))
    w_s = window_hours * HOUR
    base = txns.filter((F.col("amount_cents") < lim) & F.col("timestamp").isNotNull()).select("sender_id", "transaction_id", "timestamp", "amount_cents", _sec().alias("_s"))
    per = base.groupBy("sender_id", "_s").agg(F.count(F.lit(1)).alias("n"), F.sum("amount_cents").alias("c"))
    comes = F.struct(F.col("_s").alias("t"), F.lit(1).alias("kind"), F.col("n").alias("n"), F.col("c").alias("c"))
    goes = F.struct((F.col("_s") + w_s + 1).alias("t"), F.lit(0).alias("kind"), (-F.col("n")).alias("n"), (-F.col("c")).alias("c"))
    events = per.select("sender_id", F.explode(F.array(comes, goes)).alias("e")).select("sender_id", "e.*")
    run = prefix_sums(events, [F.col("sender_id"), F.col("t"), F.col("kind")], ["n", "c"])
    hits = run.filter((F.col("kind") == 1) & (F.col("n_cum") >= min_count)).select(
        F.col("sender_id").alias("_sender"), F.col("t").alias("_t"), F.col("n_cum").alias("txn_count"), (F.col("c_cum") / F.lit(100.0)).alias("total_usd")
    )
    j = base.join(hits, F.col("sender_id").eqNullSafe(F.col("_sender")) & (F.col("_s") == F.col("_t")))
    return j.select("sender_id", "transaction_id", F.col("timestamp").alias("window_end"), "txn_count", "total_usd")


def _hops(txns: DataFrame) -> DataFrame:
    return txns.select("transaction_id", "sender_id", "receiver_id", "amount_cents", _sec().alias("s"))


def _bucketed_next(left: DataFrame, right: DataFrame, lkey: list[str], rkey: list[str], max_gap: int, lsec: str, rsec: str) -> DataFrame:
    """Interval join right.s in (left.s, left.s + max_gap] on equal keys, with a
    bucket of twice max_gap as extra equi key (every second left row or so reaches into
    the next bucket and is copied to it)."""
    width = 2 * max_gap
    lb = left.select("*", F.explode(F.sequence(F.floor(F.col(lsec) / width), F.floor((F.col(lsec) + max_gap) / width))).alias("_b"))
    rb = right.select("*", F.floor(F.col(rsec) / width).alias("_rb"))
    cond = [lb[a] == rb[b] for a, b in zip(lkey, rkey)] + [lb["_b"] == rb["_rb"]]
    j = lb.join(rb, cond, "inner")
    return j.filter((F.col(rsec) > F.col(lsec)) & (F.col(rsec) <= F.col(lsec) + max_gap)).drop("_b", "_rb")


def round_trips(
    txns: DataFrame, depth: int = 2, max_hop_days: float = 7, min_hop_hours: float = 0, kept: tuple[int, int] | None = None
) -> DataFrame:
    """Chains A -> ... -> A of ``depth`` hops through distinct accounts, each hop
    later than the previous by more than ``min_hop_hours`` less a second and at
    most ``max_hop_days``. With ``kept`` = (low, high) in percent, hop i (from 0)
    carries between (low %)^i and (high %)^i of the *first* hop's amount, each to
    the nearest cent (90 and 99 for laundered money less fees that compound). The
    conditions are part of each hop's join, so a path that breaks one never reaches
    the next.

    Transfers of equal accounts, second and (with ``kept``) amount meet the same
    conditions, so paths are made of these alone, as numbers; ids and amounts of all
    transfers alike are joined to the chains found."""
    gap, least = int(max_hop_days * DAY), int(min_hop_hours * 3600)
    own = ["s", "c"] if kept else ["s"]
    all_hops = _hops(txns).withColumn("c", F.col("amount_cents")).filter((F.col("sender_id") != F.col("receiver_id")) & F.col("s").isNotNull())
    with passing_cuts(txns.sparkSession) as keep:
        # Exact pruning: every hop of a closed chain starts at an account that also
        # receives and ends at one that also sends, so transfers out of pure
        # senders or into pure receivers (one-directional hubs) never join paths.
        receivers = all_hops.select(F.col("receiver_id").alias("account")).distinct()
        senders = all_hops.select(F.col("sender_id").alias("account")).distinct()
        index = cut_lineage(receivers.join(senders, "account").select("account", F.monotonically_increasing_id().alias("n")))
        numbers = lambda c, n: index.select(F.col("account").alias(c), F.col("n").alias(n))
        # written: every hop's join reads it
        h = all_hops.select("sender_id", "receiver_id", *own).join(numbers("sender_id", "a"), "sender_id").drop("sender_id")
        h = cut_lineage(h.join(numbers("receiver_id", "b"), "receiver_id").select("a", "b", *own))
        path = h.select(F.col("a").alias("a0"), F.col("b").alias("a1"), *[F.col(x).alias(f"{x}1") for x in own])
        for i in range(2, depth + 1):
            nxt = h.select(F.col("a").alias(f"_src{i}"), F.col("b").alias(f"a{i}"), *[F.col(x).alias(f"{x}{i}") for x in own])
            if i == depth:
                # closing hop: equi on both ends
                path = _bucketed_next(path, nxt, [f"a{i - 1}", "a0"], [f"_src{i}", f"a{i}"], gap, f"s{i - 1}", f"s{i}")
            else:
                path = _bucketed_next(path, nxt, [f"a{i - 1}"], [f"_src{i}"], gap, f"s{i - 1}", f"s{i}")
                seen = [F.col(f"a{j}") for j in range(i)]
                path = path.filter(~F.col(f"a{i}").isin(*seen))
            if least:
                path = path.filter(F.col(f"s{i}") - F.col(f"s{i - 1}") >= least)
            if kept:
                # exact: c_i within half a cent of c_1 * (kept / 100)^(i - 1), without division
                exact = lambda x: x.cast("decimal(38,0)")
                whole = 100 ** (i - 1)
                low, high = (exact(F.col("c1")) * F.lit(2 * k ** (i - 1)).cast("decimal(18,0)") for k in kept)
                mine = exact(F.col(f"c{i}")) * F.lit(2 * whole).cast("decimal(18,0)")
                path = path.filter((F.col("c1") > 0) & (mine + whole >= low) & (mine - whole <= high))
            path = path.drop(f"_src{i}")
        found = cut_lineage(path.distinct())
        hop = lambda i: F.struct(F.col(f"a{i - 1}").alias("a"), F.col(f"a{i}").alias("b"), *[F.col(f"{x}{i}").alias(x) for x in own])
        met = found.select(F.explode(F.array(*[hop(i) for i in range(1, depth + 1)])).alias("h")).select("h.*").distinct()
        met = cut_lineage(met.join(numbers("sender_id", "a"), "a").join(numbers("receiver_id", "b"), "b"))
        alike = cut_lineage(all_hops.join(met, ["sender_id", "receiver_id", *own]).select("a", "b", *own, "sender_id", "transaction_id", "amount_cents"))
        for i in range(1, depth + 1):
            name = {"a": f"a{i - 1}", "b": f"a{i}", "sender_id": f"via{i - 1}", "transaction_id": f"t{i}", "amount_cents": f"cents{i}", **{x: f"{x}{i}" for x in own}}
            found = found.join(alike.select(*[F.col(x).alias(y) for x, y in name.items()]), [f"a{i - 1}", f"a{i}", *[f"{x}{i}" for x in own]])
        return keep(
            found.select(
                F.col("via0").alias("origin_id"),
                *[F.col(f"via{j}").alias(f"via_{j}") for j in range(1, depth)],
                *[F.col(f"t{j}").alias(f"txn_{j}") for j in range(1, depth + 1)],
                (F.col("cents1") / F.lit(100.0)).alias("first_amount_usd"),
                (F.col(f"cents{depth}") / F.lit(100.0)).alias("last_amount_usd"),
                ((F.col(f"s{depth}") - F.col("s1")) / F.lit(3600.0)).alias("span_hours"),
            )
        )


def rapid_movement(txns: DataFrame, within_hours: int = 24) -> DataFrame:
    """For each incoming transfer, the account's next outgoing transfer (an
    as-of lookup, no pair enumeration): kept when it leaves within
    ``within_hours`` (0 < delay <= H).

    A segmented scan: events are range-sorted by (account, time from late to early), so
    an account's rows may lie in any number of tasks; each task carries the latest
    outgoing row it has passed, and one row a task, its last account and that
    account's carried row, tells the next task what lies before its first rows."""
    reach = within_hours * HOUR
    ins = txns.select(F.col("receiver_id").alias("account_id"), _sec().alias("s"), F.lit(0).alias("is_out"), F.col("transaction_id").alias("txn"))
    outs = txns.select(F.col("sender_id").alias("account_id"), _sec().alias("s"), F.lit(1).alias("is_out"), F.col("transaction_id").alias("txn"))
    events = ins.unionByName(outs).filter("account_id is not null and s is not null")
    # at equal seconds outgoing rows come after incoming ones, so they never count as later; the smallest id comes last
    order = [F.col("account_id"), F.col("s").desc(), F.col("is_out"), F.col("txn").desc()]
    n = max(int(txns.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), 2)
    ranged = events.repartitionByRange(n, *order).sortWithinPartitions(*order)
    rows = cut_lineage(ranged.mapInArrow(_next_out(), "pid int, kind string, account_id string, s long, txn string, os long, out_txn string"))
    # one row a task, in order: what the task before hands on
    handed, before = [], None
    for r in sorted(rows.filter("kind = 'last'").collect(), key=lambda r: r["pid"]):
        handed.append((r["pid"], *(before or (None, None, None))))
        if r["os"] is not None or before is None or before[0] != r["account_id"] or r["txn"] is not None:
            before = (r["account_id"], r["os"], r["out_txn"])
    carried = txns.sparkSession.createDataFrame(handed, "hp int, ha string, hs long, ht string")
    own = rows.filter("kind = 'in'").select("account_id", "s", "txn", "os", "out_txn")
    late = rows.filter("kind = 'open'").join(F.broadcast(carried), (F.col("pid") == F.col("hp")) & (F.col("account_id") == F.col("ha")))
    both = own.unionByName(late.select("account_id", "s", "txn", F.col("hs").alias("os"), F.col("ht").alias("out_txn")))
    return both.filter((F.col("os") > F.col("s")) & (F.col("os") <= F.col("s") + reach)).select(
        "account_id", F.col("txn").alias("in_txn"), "out_txn", ((F.col("os") - F.col("s")) / F.lit(3600.0)).alias("delay_hours")
    )


def _next_out():
    """Task function: rows (account, s, is_out, txn) in order -> incoming rows with the latest outgoing row
    passed in this task: 'in', or 'open' where the task's first account has had none yet; and
    a row 'last' with the task's last account (txn set if the account began in this task)."""

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        first = account = None
        held = (None, None)  # the account's latest outgoing row: second, id
        names = ["pid", "kind", "account_id", "s", "txn", "os", "out_txn"]

        def batch(kind, acc, s, txn, os, out):
            k = len(acc)
            cols = [pa.array(np.full(k, pid, np.int32)), pa.array([kind] * k, pa.string()) if isinstance(kind, str) else kind, acc, s, txn, os, out]
            return pa.RecordBatch.from_arrays(cols, names=names)

        for b in batches:
            if not b.num_rows:
                continue
            acc, s, is_out, txn = (b.column(i) for i in range(4))
            k = b.num_rows
            if first is None:
                first = acc[0].as_py()
            code = np.asarray(acc.dictionary_encode().indices)
            new = np.concatenate([[acc[0].as_py() != account], code[1:] != code[:-1]])
            start = np.maximum.accumulate(np.where(new, np.arange(k), -1))  # -1: the account goes on from the batch before
            out = np.asarray(is_out) == 1
            latest = np.maximum.accumulate(np.where(out, np.arange(k), -1))
            seen = latest >= np.maximum(start, 0)
            sec = np.asarray(s)
            os = [None] * k if held[0] is None else [held[0] if x < 0 else None for x in start.tolist()]
            ids = [None] * k if held[0] is None else [held[1] if x < 0 else None for x in start.tolist()]
            texts = txn.to_pylist()
            for i in np.flatnonzero(seen & ~out).tolist():
                os[i], ids[i] = int(sec[latest[i]]), texts[latest[i]]
            names_in = np.flatnonzero(~out)
            accounts = acc.to_pylist()
            kinds = pa.array(["open" if os[i] is None and accounts[i] == first else "in" for i in names_in.tolist()], pa.string())
            pick = pa.array(names_in)
            yield batch(kinds, acc.take(pick), s.take(pick), txn.take(pick), pa.array([os[i] for i in names_in.tolist()], pa.int64()), pa.array([ids[i] for i in names_in.tolist()], pa.string()))
            account = accounts[-1]
            if seen[-1]:
                held = (int(sec[latest[-1]]), texts[latest[-1]])
            elif start[-1] >= 0:
                held = (None, None)
        if first is not None:
            began = None if account == first else "began"
            yield batch("last", pa.array([account], pa.string()), pa.nulls(1, pa.int64()), pa.array([began], pa.string()), pa.array([held[0]], pa.int64()), pa.array([held[1]], pa.string()))

    return run


def tbml_pairs(txns: DataFrame, min_amount_usd: float = SAR_THRESHOLD_USD, min_count: int = 2, gap_days=(1, 14),
               chunk_days: int = 30) -> DataFrame:
    """(sender, receiver) pairs with >= min_count trade payments of at least
    ``min_amount_usd``; consecutive gaps (days) and whether all fall in range.
    Gaps are found per (pair, time chunk) with ``lag``, plus one gap per chunk
    border from a per-pair window over chunk summaries (one row per chunk),
    so a hot pair is split across tasks."""
    lim = int(round(min_amount_usd * 100))
    t = txns.filter((F.col("transaction_type") == "TRADE_PAYMENT") & (F.col("amount_cents") >= lim)).select(
        "sender_id", "receiver_id", "amount_cents", "transaction_id", _sec().alias("_s"),
    ).withColumn("_c", F.floor(F.col("_s") / (chunk_days * DAY)))
    w = Window.partitionBy("sender_id", "receiver_id", "_c").orderBy("_s", "transaction_id")
    inner = t.select("sender_id", "receiver_id", ((F.col("_s") - F.lag("_s").over(w)) / F.lit(float(DAY))).alias("_gap"))
    chunks = t.groupBy("sender_id", "receiver_id", "_c").agg(
        F.min("_s").alias("_lo"), F.max("_s").alias("_hi"), F.count(F.lit(1)).alias("_n"),
        F.sum("amount_cents").alias("_cents"),
    )
    wc = Window.partitionBy("sender_id", "receiver_id").orderBy("_c")
    border = chunks.select(
        "sender_id", "receiver_id", ((F.col("_lo") - F.lag("_hi").over(wc)) / F.lit(float(DAY))).alias("_gap")
    )
    gaps = inner.unionByName(border).filter(F.col("_gap").isNotNull()).groupBy("sender_id", "receiver_id").agg(
        F.min("_gap").alias("_gmin"), F.max("_gap").alias("_gmax"),
        F.bool_and((F.col("_gap") >= gap_days[0]) & (F.col("_gap") <= gap_days[1])).alias("_ok"),
    )
    tot = chunks.groupBy("sender_id", "receiver_id").agg(
        F.sum("_n").alias("payment_count"), (F.sum("_cents") / F.lit(100.0)).alias("total_usd")
    )
    return tot.filter(F.col("payment_count") >= min_count).join(gaps, ["sender_id", "receiver_id"], "left").select(
        "sender_id", "receiver_id", "payment_count", "total_usd",
        F.round("_gmin", 6).alias("min_gap_days"), F.round("_gmax", 6).alias("max_gap_days"),
        F.coalesce("_ok", F.lit(True)).alias("gaps_in_range"),
    )


def fan_out(txns: DataFrame, min_partners: int = 5) -> DataFrame:
    return (
        txns.groupBy("sender_id", F.to_date("timestamp").alias("date"))
        .agg(
            F.countDistinct("receiver_id").alias("distinct_receivers"),
            F.count(F.lit(1)).alias("txn_count"),
            sum_usd(F.col("amount_cents")).alias("total_usd"),
        )
        .filter(F.col("distinct_receivers") >= min_partners)
    )


def fan_in(txns: DataFrame, min_partners: int = 5) -> DataFrame:
    return (
        txns.groupBy("receiver_id", F.to_date("timestamp").alias("date"))
        .agg(
            F.countDistinct("sender_id").alias("distinct_senders"),
            F.count(F.lit(1)).alias("txn_count"),
            sum_usd(F.col("amount_cents")).alias("total_usd"),
        )
        .filter(F.col("distinct_senders") >= min_partners)
    )


def near_threshold(txns: DataFrame, threshold_usd: float = SAR_THRESHOLD_USD, below_hi: float = 499.0, below_lo: float = 10.0) -> DataFrame:
    lo = int(round((threshold_usd - below_hi) * 100))
    hi = int(round((threshold_usd - below_lo) * 100))
    near = F.col("amount_cents").between(lo, hi)
    return (
        txns.groupBy("sender_id")
        .agg(F.count_if(near).alias("near_count"), F.count(F.lit(1)).alias("txn_count"))
        .filter(F.col("near_count") > 0)
        .select("sender_id", "near_count", "txn_count", ratio_dp(F.col("near_count"), F.col("txn_count")).alias("near_share"))
    )


def rule_risk_score(txns: DataFrame, custs: DataFrame, threshold_usd: float = SAR_THRESHOLD_USD) -> DataFrame:
    """min(1, 0.5 x jurisdiction base + 0.5 x structuring share + 0.5 x
    near-threshold share of the customer's sent transfers)."""
    lo = int(round((threshold_usd - 499.0) * 100))
    hi = int(round((threshold_usd - 10.0) * 100))
    beh = txns.groupBy(F.col("sender_id").alias("_sid")).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if("structuring_flag").alias("_st"),
        F.count_if(F.col("amount_cents").between(lo, hi)).alias("_nt"),
    )
    base = F.coalesce(
        F.create_map(*[x for k, v in JURISDICTION_BASE_RISK.items() for x in (F.lit(k), F.lit(v))])[F.col("jurisdiction_risk")],
        F.lit(JURISDICTION_BASE_RISK["medium"]),
    )
    c = custs.select("customer_id", "jurisdiction_risk").join(beh, F.col("customer_id") == F.col("_sid"), "left")
    n = F.greatest(F.coalesce("_n", F.lit(0)), F.lit(1))
    st = F.coalesce("_st", F.lit(0)) / n
    nt = F.coalesce("_nt", F.lit(0)) / n
    score = F.least(F.lit(1.0), base * F.lit(0.5) + F.lit(0.5) * st + F.lit(0.5) * nt)
    return c.select("customer_id", "jurisdiction_risk", round_hu(score, 6).alias("rule_risk_score"))
