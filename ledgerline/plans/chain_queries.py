"""Queries over blocks, transactions and arrivals."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline.functions.hexes import packed, unpacked
from ledgerline.functions.text import segment_label, segment_of
from ledgerline.operators import bands, compare, feed, forks, integrity, scans, scroll, totals
from ledgerline.operators.bloom import bloom_or
from ledgerline.plans import views as V
from ledgerline.plans import jobs
from ledgerline.plans.registry import query
from ledgerline.session import shared_folder, shuffles_dropped
from ledgerline.sources import tables
from ledgerline.streaming import rates

# --- totals, index, running gas -------------------------------------------------


@query(
    "block_totals",
    """SELECT b.block_num, b.evm_block_num, CAST(coalesce(sum(t.gasused), 0) AS BIGINT) AS gas_used,
              CAST(coalesce(sum(t.part), 0) AS BIGINT) AS size, count(t.block) AS tx_count
       FROM v_blocks b LEFT JOIN v_tx t ON t.block = b.evm_block_num GROUP BY ALL""",
    (V.V_BLOCKS, V.V_TX),
)
def block_totals(spark, folder):
    return totals.block_totals(V.blocks(spark, folder), V.transactions(spark, folder), F.col("part"))


@query("tx_index", "SELECT block, trx_index, part, supp, price FROM v_tx", (V.V_TX,))
def tx_index(spark, folder):
    return V.indexed(spark, folder).select("block", "trx_index", "part", "supp", "price")


@query(
    "running_gas",
    """SELECT block, trx_index, gasused,
              CAST(sum(gasused) OVER (PARTITION BY block ORDER BY trx_index) AS BIGINT) AS gasusedblock
       FROM v_tx""",
    (V.V_TX,),
)
def running_gas(spark, folder):
    ranked = V.indexed(spark, folder, gasusedblock=F.col("gasused"))
    return ranked.select("block", "trx_index", "gasused", "gasusedblock")


# --- scans and lookups ----------------------------------------------------------


@query(
    "block_range_scan",
    "SELECT block_num, evm_hash FROM v_blocks WHERE block_num >= 100",
    (V.V_BLOCKS,),
)
def block_range_scan(spark, folder):
    return scans.block_range(V.blocks(spark, folder), 100, None, ["evm_hash"], V.PER_SEGMENT)


@query(
    "tx_range_scan",
    f"SELECT block, trx_index, hash FROM v_tx WHERE block >= 100 - {V.DELTA}",
    (V.V_TX,),
)
def tx_range_scan(spark, folder):
    ranked = scans.tx_range(V.indexed(spark, folder), 100, None, V.DELTA, V.PER_SEGMENT)
    return ranked.select("block", "trx_index", "hash")


@query("first_block", "SELECT block_num, evm_hash FROM v_blocks ORDER BY block_num LIMIT 1", (V.V_BLOCKS,))
def first_block(spark, folder):
    return scans.first_block(V.blocks(spark, folder), ["block_num", "evm_hash"])


@query("last_block", "SELECT block_num, evm_hash FROM v_blocks ORDER BY block_num DESC LIMIT 1", (V.V_BLOCKS,))
def last_block(spark, folder):
    return scans.last_block(V.blocks(spark, folder), ["block_num", "evm_hash"])


@query(
    "block_lookup",
    f"""SELECT w.block_num, CASE count(s.block_num) WHEN 0 THEN 'missing' WHEN 1 THEN 'found'
               ELSE 'ambiguous' END AS status,
               CASE count(s.block_num) WHEN 1 THEN min(s.evm_hash) ELSE '' END AS evm_hash
        FROM (SELECT DISTINCT 2 * l_orderkey + {V.DELTA} AS block_num FROM lineitem) w
        LEFT JOIN (SELECT * FROM v_blocks UNION ALL
                   SELECT * FROM v_blocks WHERE o_orderpriority = '1-URGENT') s USING (block_num)
        GROUP BY w.block_num""",
    (V.V_BLOCKS,),
)
def block_lookup(spark, folder):
    blocks = V.blocks(spark, folder)
    stored = blocks.unionAll(blocks.where("o_orderpriority = '1-URGENT'"))
    wanted = V.table(spark, folder, "lineitem").select((2 * F.col("l_orderkey") + V.DELTA).alias("block_num"))
    found = scans.lookup_blocks(stored, wanted)
    return found.withColumn("evm_hash", F.coalesce("evm_hash", F.lit("")))


@query(
    "segments",
    "SELECT DISTINCT segment, lpad(CAST(segment AS VARCHAR), 8, '0') AS label FROM v_blocks",
    (V.V_BLOCKS,),
)
def segments(spark, folder):
    found = scans.segments(V.blocks(spark, folder))
    return found.withColumn("label", segment_label(F.col("segment")))


@query(
    "segments_in_range",
    "SELECT DISTINCT segment FROM v_tx WHERE segment >= 1000 // 500",
    (V.V_TX,),
)
def segments_in_range(spark, folder):
    return scans.segments_in(V.transactions(spark, folder), 1000, 2**60, V.PER_SEGMENT)


@query("segment_counts", "SELECT segment, count(*) AS n FROM v_tx GROUP BY segment", (V.V_TX,))
def segment_counts(spark, folder):
    return scans.segment_counts(V.transactions(spark, folder))


@query(
    "batch_range",
    "SELECT min(block_num) AS lo, max(block_num) AS hi FROM v_blocks",
    (V.V_BLOCKS,),
)
def batch_range(spark, folder):
    return scans.batch_range(V.blocks(spark, folder))


# --- integrity ------------------------------------------------------------------


@query(
    "block_histogram",
    """SELECT s.slot * 2 AS bucket, count(k) AS n, coalesce(min(k), -1) AS lo, coalesce(max(k), -1) AS hi,
              coalesce(count(k) = max(k) - min(k) + 1, false) AS complete
       FROM (SELECT unnest(generate_series(
               (SELECT min(l_orderkey) // 2 FROM lineitem), (SELECT max(l_orderkey) // 2 FROM lineitem))) AS slot) s
       LEFT JOIN (SELECT l_orderkey AS k FROM lineitem) t ON t.k // 2 = s.slot
       GROUP BY s.slot""",
)
def block_histogram(spark, folder):
    found = integrity.block_histogram(V.transactions(spark, folder), "block", 2)
    return found.withColumns({"lo": F.coalesce("lo", F.lit(-1)), "hi": F.coalesce("hi", F.lit(-1))})


@query(
    "bucket_completeness",
    """SELECT (l_orderkey // 10) * 10 AS bucket, count(*) AS n, min(l_orderkey) AS lo, max(l_orderkey) AS hi
       FROM (SELECT DISTINCT l_orderkey FROM lineitem) GROUP BY 1 HAVING count(*) <> max(l_orderkey) - min(l_orderkey) + 1""",
)
def bucket_completeness(spark, folder):
    numbers = V.transactions(spark, folder).select("block").distinct()
    return integrity.incomplete_buckets(numbers, "block", 10)


@query(
    "duplicate_blocks",
    "SELECT l_orderkey AS block, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1",
)
def duplicate_blocks(spark, folder):
    return integrity.duplicates(V.transactions(spark, folder), "block")


@query("duplicate_tx", "SELECT hash, count(*) AS n FROM v_tx GROUP BY hash HAVING count(*) > 1", (V.V_TX,))
def duplicate_tx(spark, folder):
    return integrity.duplicates(V.transactions(spark, folder), "hash", 0, None, "block")


@query("duplicate_tx_marks", "SELECT hash, count(*) AS n FROM v_tx GROUP BY hash HAVING count(*) > 1", (V.V_TX,))
def duplicate_tx_marks(spark, folder):
    return integrity.duplicates_by_fingerprint(V.transactions(spark, folder), "hash")


@query("duplicate_prices", "SELECT part, price, count(*) AS n FROM v_tx GROUP BY ALL HAVING count(*) > 1", (V.V_TX,))
def duplicate_prices(spark, folder):
    """Keys of two columns, of which many repeat."""
    return integrity.duplicates_by_fingerprint(V.transactions(spark, folder), ["part", "price"])


@query(
    "scroll_slots",
    "SELECT block // 2000 AS slot, min(block) AS lo, max(block) AS hi, count(*) AS n FROM v_tx GROUP BY 1",
    (V.V_TX,),
)
def scroll_slots(spark, folder):
    """The slots that a scroll in batches of 2,000 is cut by."""
    return scroll.slots(V.transactions(spark, folder), "block", 2000)


@query(
    "duplicate_tx_top",
    "SELECT hash, count(*) AS n FROM v_tx GROUP BY hash HAVING count(*) > 1 ORDER BY n DESC, hash LIMIT 100",
    (V.V_TX,),
)
def duplicate_tx_top(spark, folder):
    return integrity.duplicates(V.transactions(spark, folder), "hash", limit=100)


GAPS_SQL = """SELECT k AS last_before, k + 1 AS first_missing, nxt AS first_after, nxt - k - 1 AS missing
  FROM (SELECT k, lead(k) OVER (ORDER BY k) AS nxt FROM (SELECT DISTINCT l_orderkey AS k FROM lineitem))
  WHERE nxt - k > 1"""


@query("gaps", GAPS_SQL)
def gaps(spark, folder):
    return integrity.gaps(V.transactions(spark, folder), "block")


@query("first_gap", GAPS_SQL + " ORDER BY k LIMIT 1")
def first_gap(spark, folder):
    return integrity.first_gap(V.transactions(spark, folder), "block")


@query(
    "segment_gaps",
    """SELECT segment AS gap_start, nxt AS gap_end
       FROM (SELECT segment, lead(segment) OVER (ORDER BY segment) AS nxt
             FROM (SELECT DISTINCT l_orderkey // 2 AS segment FROM lineitem)) WHERE nxt - segment > 1""",
)
def segment_gaps(spark, folder):
    txs = V.transactions(spark, folder)
    return scans.segment_gaps(txs.withColumn("segment", segment_of(F.col("block"), 2)))


@query(
    "number_delta_check",
    f"""SELECT block_num, evm, block_num - evm AS found_delta
        FROM (SELECT block_num, evm_block_num - CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS evm FROM v_blocks)
        WHERE block_num - evm <> {V.DELTA}""",
    (V.V_BLOCKS,),
)
def number_delta_check(spark, folder):
    shifted = F.col("evm_block_num") - F.when(F.col("o_orderstatus") == "P", 1).otherwise(0)
    blocks = V.blocks(spark, folder).withColumn("evm_block_num", shifted)
    return integrity.number_delta_check(blocks, V.DELTA).withColumnRenamed("evm_block_num", "evm")


V_BREAKS = """v_breaks AS (
  SELECT b.block_num, b.evm_prev_hash, p.evm_hash AS parent_hash
  FROM v_blocks b JOIN v_blocks p ON p.block_num = b.block_num - 1 WHERE b.evm_prev_hash <> p.evm_hash)"""


@query("parent_link_breaks", "SELECT * FROM v_breaks", (V.V_BLOCKS, V_BREAKS))
def parent_link_breaks(spark, folder):
    return integrity.parent_link_breaks(V.blocks(spark, folder))


@query(
    "orphan_tx",
    """SELECT block, trx_index, hash FROM v_tx
       WHERE block NOT IN (SELECT evm_block_num FROM v_blocks WHERE o_orderstatus <> 'P')""",
    (V.V_BLOCKS, V.V_TX),
)
def orphan_tx(spark, folder):
    known = V.blocks(spark, folder).where("o_orderstatus <> 'P'")
    return integrity.orphan_transactions(V.indexed(spark, folder), known).select("block", "trx_index", "hash")


V_STORED = f"""v_stored AS (
  SELECT l_orderkey + {V.DELTA} + CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN 1 ELSE 0 END AS block_num,
         l_orderkey AS evm_block_num, l_orderkey // 2 AS segment FROM lineitem)"""


INTEGRITY_SQL = (
    f"""SELECT 'number_delta' AS "check", CAST(block_num AS VARCHAR) AS "key",
               'delta ' || (block_num - evm_block_num) AS detail
        FROM v_stored WHERE block_num - evm_block_num <> {V.DELTA}
        UNION ALL
        SELECT 'duplicate_block', CAST(evm_block_num AS VARCHAR), 'copies ' || count(*)
        FROM v_stored GROUP BY evm_block_num HAVING count(*) > 1
        UNION ALL
        SELECT 'duplicate_tx', hash, 'copies ' || count(*) FROM v_tx GROUP BY hash HAVING count(*) > 1
        UNION ALL
        SELECT 'missing_segment', CAST(segment AS VARCHAR), 'next ' || nxt
        FROM (SELECT segment, lead(segment) OVER (ORDER BY segment) AS nxt FROM (SELECT DISTINCT segment FROM v_stored))
        WHERE nxt - segment > 1
        UNION ALL
        SELECT 'gap', CAST(k AS VARCHAR), 'missing ' || (nxt - k - 1) || ' native ' || (k + {V.DELTA})
        FROM (SELECT k, lead(k) OVER (ORDER BY k) AS nxt FROM (SELECT DISTINCT evm_block_num AS k FROM v_stored))
        WHERE nxt - k > 1"""
)


@query("integrity_report", INTEGRITY_SQL, (V.V_TX, V_STORED))
def integrity_report(spark, folder):
    line = V.table(spark, folder, "lineitem")
    shift = F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 7), 1).otherwise(0)
    stored = line.select(
        (F.col("l_orderkey") + V.DELTA + shift).alias("block_num"),
        F.col("l_orderkey").alias("evm_block_num"),
        segment_of(F.col("l_orderkey"), 2).alias("segment"),
    )
    return integrity.integrity_report(stored, V.transactions(spark, folder), V.DELTA)


V_STORED_WIDE = V_STORED.replace("l_orderkey // 2", f"l_orderkey // {V.PER_SEGMENT}")


@query("integrity_by_segments", INTEGRITY_SQL, (V.V_TX, V_STORED_WIDE))
def integrity_by_segments(spark, folder):
    """The report from summaries: half of the segments are stored and checked; once the others are there, only they are read."""
    line = V.table(spark, folder, "lineitem")
    shift = F.when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 7), 1).otherwise(0)
    segment = segment_of(F.col("l_orderkey"), V.PER_SEGMENT).alias("segment")
    blocks = line.select((F.col("l_orderkey") + V.DELTA + shift).alias("block_num"), F.col("l_orderkey").alias("evm_block_num"), segment)
    txs = V.transactions(spark, folder)
    txs = txs.select("block", "block_num", "hash", segment_of(F.col("block"), V.PER_SEGMENT).alias("segment"))
    path = f"{shared_folder(spark)}/query-{uuid.uuid4().hex}"
    for half in (0, 1):
        now = F.pmod(F.col("segment"), F.lit(2)) == half
        tables.write_table(blocks.where(now), f"{path}/blocks", ("segment", "block_num"))
        tables.write_table(txs.where(now), f"{path}/transactions", ("segment", "block"))
        report, _ = jobs.check_changed(spark, path, V.DELTA)
    return report


# --- forks ----------------------------------------------------------------------


@query("fork_events", "SELECT arrival_seq, last_non_forked, last_forked FROM v_forks", (V.V_ARRIVALS, V.V_FORKS))
def fork_events(spark, folder):
    return forks.fork_events(V.arrivals(spark, folder)).drop("ts")


V_LATER = """v_later AS (
  SELECT *, min(n) OVER (ORDER BY arrival_seq ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS later
  FROM v_arrivals)"""


@query(
    "canonical_chain",
    "SELECT arrival_seq, n FROM v_later WHERE later IS NULL OR later > n",
    (V.V_ARRIVALS, V_LATER),
)
def canonical_chain(spark, folder):
    return forks.canonical_chain(V.arrivals(spark, folder).select("arrival_seq", "n"))


@query(
    "discarded_arrivals",
    "SELECT arrival_seq, n FROM v_later WHERE later <= n",
    (V.V_ARRIVALS, V_LATER),
)
def discarded_arrivals(spark, folder):
    return forks.discarded(V.arrivals(spark, folder).select("arrival_seq", "n"))


@query(
    "sequence_gaps",
    """SELECT arrival_seq, n, prev + 1 AS expected
       FROM (SELECT arrival_seq, jumping_n AS n, lag(jumping_n) OVER (ORDER BY arrival_seq) AS prev FROM v_arrivals)
       WHERE n > prev + 1""",
    (V.V_ARRIVALS,),
)
def sequence_gaps(spark, folder):
    jumping = V.arrivals(spark, folder).select("arrival_seq", F.col("jumping_n").alias("n"))
    return forks.sequence_gaps(jumping)


@query(
    "double_forks",
    """SELECT arrival_seq, last_non_forked, prev AS prev_last_non_forked
       FROM (SELECT *, lag(last_non_forked) OVER (ORDER BY arrival_seq) AS prev FROM v_forks)
       WHERE last_non_forked - prev < 45""",
    (V.V_ARRIVALS, V.V_FORKS),
)
def double_forks(spark, folder):
    log = forks.fork_events(V.arrivals(spark, folder))
    found = forks.double_forks(log, 45)
    return found.select("arrival_seq", "last_non_forked", "prev_last_non_forked")


@query(
    "fork_neighbourhood_check",
    """SELECT f.arrival_seq, f.last_non_forked, count(b.block_num) = 0 AS ok, count(b.block_num) AS breaks,
              CASE count(b.block_num) WHEN 0 THEN 'All hashes follow the rule' ELSE
              'Mismatch at block ' || min(b.block_num) || ': ' || arg_min(b.evm_prev_hash, b.block_num) || ' != '
              || arg_min(b.parent_hash, b.block_num) END AS message
       FROM v_forks f LEFT JOIN v_breaks b
         ON b.block_num BETWEEN f.last_non_forked - 100 + 1 AND f.last_non_forked + 100
       GROUP BY 1, 2""",
    (V.V_BLOCKS, V_BREAKS, V.V_ARRIVALS, V.V_FORKS),
)
def fork_neighbourhood_check(spark, folder):
    log = forks.fork_events(V.arrivals(spark, folder))
    return integrity.fork_neighbourhood_check(log, V.blocks(spark, folder))


@query(
    "actions_near_forks",
    f"""SELECT f.arrival_seq, f.last_non_forked, count(*) AS actions, count(DISTINCT a.block_num) AS blocks
       FROM v_forks f JOIN v_actions a ON a.block_num BETWEEN f.last_non_forked + 1 - {K.FORK_CHECK_WIDTH} AND f.last_forked + {K.FORK_CHECK_WIDTH}
       GROUP BY 1, 2""",
    (V.V_ARRIVALS, V.V_FORKS, V.V_ACTIONS),
)
def actions_near_forks(spark, folder):
    """Actions that a fork touches or nearly touches; the deeper the fork, the wider its interval."""
    low, high = F.col("last_non_forked") + 1 - K.FORK_CHECK_WIDTH, F.col("last_forked") + K.FORK_CHECK_WIDTH
    log = forks.fork_events(V.arrivals(spark, folder)).select("arrival_seq", "last_non_forked", low.alias("low"), high.alias("high"))
    actions = V.actions(spark, folder, with_raw=False).groupBy("block_num").agg(F.count(F.lit(1)).alias("n"))
    near = bands.band_join(actions, log, "block_num", "low", "high", 2 * K.FORK_CHECK_WIDTH)
    return near.groupBy("arrival_seq", "last_non_forked").agg(F.sum("n").alias("actions"), F.count(F.lit(1)).alias("blocks"))


@query(
    "fork_old_hash",
    """SELECT f.arrival_seq, f.last_non_forked, coalesce(b.evm_hash, '') AS old_hash
       FROM v_forks f LEFT JOIN v_blocks b ON b.block_num = f.last_non_forked""",
    (V.V_BLOCKS, V.V_ARRIVALS, V.V_FORKS),
)
def fork_old_hash(spark, folder):
    log = forks.fork_events(V.arrivals(spark, folder))
    found = forks.old_hashes(log, V.blocks(spark, folder))
    return found.select("arrival_seq", "last_non_forked", F.coalesce("old_hash", F.lit("")).alias("old_hash"))


# --- table jobs -----------------------------------------------------------------


def _two_versions(spark, folder):
    left = V.blocks(spark, folder).select("block_num", "evm_hash", "size", "o_orderstatus", "o_orderpriority")
    changed = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("size") + 1).otherwise(F.col("size"))
    right = left.where("not (o_orderstatus = 'P' and o_orderpriority = '5-LOW')").withColumn("size", changed)
    extra = left.where("o_orderstatus = 'F' and o_orderpriority = '2-HIGH'").withColumn(
        "block_num", -F.col("block_num")
    )
    keep = ["block_num", "evm_hash", "size"]
    return left.select(*keep), right.select(*keep).unionAll(extra.select(*keep))


V_VERSIONS = """v_left AS (SELECT block_num, evm_hash, size FROM v_blocks),
v_right AS (
  SELECT block_num, evm_hash, CASE WHEN o_orderpriority = '1-URGENT' THEN size + 1 ELSE size END AS size
  FROM v_blocks WHERE NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW')
  UNION ALL
  SELECT -block_num, evm_hash, size FROM v_blocks WHERE o_orderstatus = 'F' AND o_orderpriority = '2-HIGH')"""


@query(
    "compare_tables",
    """SELECT CASE WHEN r.block_num IS NULL THEN 'only_left' WHEN l.block_num IS NULL THEN 'only_right'
                   ELSE 'differs' END AS status,
              coalesce(l.block_num, r.block_num) AS block_num,
              CASE WHEN l.block_num IS NOT NULL AND r.block_num IS NOT NULL THEN 'size' ELSE '' END AS diff_columns,
              CAST(l.block_num IS NOT NULL AS BIGINT) AS n_left, CAST(r.block_num IS NOT NULL AS BIGINT) AS n_right
       FROM v_left l FULL JOIN v_right r ON l.block_num = r.block_num
       WHERE l.size IS DISTINCT FROM r.size OR l.evm_hash IS DISTINCT FROM r.evm_hash""",
    (V.V_BLOCKS, V_VERSIONS),
)
def compare_tables(spark, folder):
    return compare.compare_tables(*_two_versions(spark, folder), "block_num")


@query(
    "compare_by_digests",
    """SELECT CASE WHEN r.block_num IS NULL THEN 'only_left' WHEN l.block_num IS NULL THEN 'only_right'
                   ELSE 'differs' END AS status,
              coalesce(l.block_num, r.block_num) AS block_num,
              CASE WHEN l.block_num IS NOT NULL AND r.block_num IS NOT NULL THEN 'size' ELSE '' END AS diff_columns,
              CAST(l.block_num IS NOT NULL AS BIGINT) AS n_left, CAST(r.block_num IS NOT NULL AS BIGINT) AS n_right
       FROM v_left l FULL JOIN v_right r ON l.block_num = r.block_num
       WHERE l.size IS DISTINCT FROM r.size OR l.evm_hash IS DISTINCT FROM r.evm_hash""",
    (V.V_BLOCKS, V_VERSIONS),
)
def compare_by_digests(spark, folder):
    """The same differences, found by descending where digests of segments and buckets differ."""
    return compare.compare_by_digests(*_two_versions(spark, folder), "block_num", segment_of(F.col("block_num"), V.PER_SEGMENT))


@query(
    "differing_rows",
    """SELECT block_num, evm_hash, size, CAST(sum(l) AS BIGINT) AS n_left, CAST(sum(r) AS BIGINT) AS n_right
       FROM (SELECT *, 1 AS l, 0 AS r FROM v_left UNION ALL SELECT *, 0, 1 FROM v_right)
       GROUP BY ALL HAVING sum(l) <> sum(r)""",
    (V.V_BLOCKS, V_VERSIONS),
)
def differing_rows(spark, folder):
    return compare.differing_rows(*_two_versions(spark, folder))


@query(
    "key_clashes",
    """SELECT DISTINCT block, line FROM v_tx WHERE block IN (SELECT evm_block_num FROM v_blocks WHERE o_orderstatus = 'P')
       UNION
       SELECT block, line FROM v_tx GROUP BY block, line HAVING count(*) > 1""",
    (V.V_BLOCKS, V.V_TX),
)
def key_clashes(spark, folder):
    new = V.transactions(spark, folder).select("block", "line")
    partial = V.blocks(spark, folder).where("o_orderstatus = 'P'").select(F.col("evm_block_num").alias("block"))
    target = new.join(partial, "block", "left_semi")
    return tables.key_clashes(new, target, ["block", "line"])


def _table(spark, rows, order):
    """``rows`` as a stored table in a new folder that all executors share."""
    path = f"{shared_folder(spark)}/query-{uuid.uuid4().hex}"
    tables.write_table(rows, path, order)
    return path


@query("create_only_append", "SELECT block, trx_index, hash FROM v_tx", (V.V_TX,))
def create_only_append(spark, folder):
    """Transactions of some blocks are stored; of all that are sent then, the new ones are appended."""
    sent = V.indexed(spark, folder).select("block", "trx_index", "hash", "segment")
    early = V.blocks(spark, folder).where("o_orderstatus = 'F'").select(F.col("evm_block_num").alias("block"))
    order = ("segment", "block", "trx_index")
    with tables.staged(sent) as sent:
        early_rows = unpacked(packed(sent, ["hash"]).join(early, "block", "left_semi"), ["hash"])
        path = _table(spark, early_rows, order)
        stored = tables.read_table(spark, path, sent.schema)
        with tables.staged(tables.new_rows(sent, stored, "block")) as new:
            tables.append_create_only(new, path, sent.schema, ("block", "trx_index"), order)
    return tables.read_table(spark, path, sent.schema).select("block", "trx_index", "hash")


@query(
    "purge_from",
    "SELECT block_num, evm_hash FROM v_blocks WHERE block_num < 10000",
    (V.V_BLOCKS,),
)
def purge_from(spark, folder):
    rows = V.blocks(spark, folder).select("block_num", "evm_hash", "segment")
    path = _table(spark, rows, ("segment", "block_num"))
    tables.purge_from(spark, path, 10000, per_segment=V.PER_SEGMENT, order=("segment", "block_num"))
    return tables.read_table(spark, path, rows.schema).select("block_num", "evm_hash")


@query(
    "delete_range",
    "SELECT block, hash FROM v_tx WHERE NOT block BETWEEN 500 AND 700",
    (V.V_TX,),
)
def delete_range(spark, folder):
    rows = V.transactions(spark, folder).select("block", "hash", "segment")
    path = _table(spark, rows, ("segment", "block"))
    lo, hi, order = 500 + V.DELTA, 700 + V.DELTA, ("segment", "block")
    tables.delete_range(spark, path, lo, hi, "block", V.DELTA, V.PER_SEGMENT, order)
    return tables.read_table(spark, path, rows.schema).select("block", "hash")


# A stand-in bloom of 2048 bits: the digest of the part, eight times over.
def _with_bloom(txs):
    return txs.withColumn("logs_bloom", F.repeat(V.sha(F.col("part").cast("string")), 8))


V_BLOOM = """v_bloom AS (
  SELECT block, repeat(string_agg(lpad(lower(to_hex(w)), 8, '0'), '' ORDER BY i), 8) AS logs_bloom
  FROM (SELECT block, i, bit_or(CAST('0x' || substr(sha256(CAST(part AS VARCHAR)), i * 8 + 1, 8) AS BIGINT)) AS w
        FROM v_tx, (SELECT unnest(range(8)) AS i) GROUP BY block, i) GROUP BY block)"""


@query("bloom_or", "SELECT block, logs_bloom FROM v_bloom", (V.V_TX, V_BLOOM))
def block_blooms(spark, folder):
    return bloom_or(_with_bloom(V.transactions(spark, folder)), "block")


REINDEXED = """SELECT b.block_num, b.evm_block_num, b.evm_hash, b.evm_prev_hash,
       CAST(coalesce(t.gas, 0) AS BIGINT) AS gas_used, b.size,
       coalesce(o.logs_bloom, repeat('0', 512)) AS logs_bloom, coalesce(t.n, 0) AS tx_count
  FROM v_blocks b
  LEFT JOIN (SELECT block, sum(gasused) AS gas, count(*) AS n FROM v_tx GROUP BY block) t ON t.block = b.evm_block_num
  LEFT JOIN v_bloom o ON o.block = b.evm_block_num"""


@query("reindex_blocks", REINDEXED, (V.V_BLOCKS, V.V_TX, V_BLOOM))
def reindex_blocks(spark, folder):
    txs = _with_bloom(V.transactions(spark, folder))
    blocks, _ = totals.reindex_blocks(V.blocks(spark, folder), txs, V.DELTA, 0, per_segment=V.PER_SEGMENT)
    return blocks.select(
        "block_num",
        "evm_block_num",
        "evm_hash",
        "evm_prev_hash",
        F.col("gas_used").cast("bigint").alias("gas_used"),
        "size",
        "logs_bloom",
        "tx_count",
    )


@query(
    "reindex_transactions",
    f"""SELECT t.block, t.part, t.supp, t.price, b.evm_hash AS block_hash
        FROM v_tx t JOIN v_blocks b ON b.evm_block_num = t.block""",
    (V.V_BLOCKS, V.V_TX),
)
def reindex_transactions(spark, folder):
    txs = _with_bloom(V.transactions(spark, folder))
    _, new = totals.reindex_blocks(V.blocks(spark, folder), txs, V.DELTA, 0, per_segment=V.PER_SEGMENT)
    return new.select("block", "part", "supp", "price", "block_hash")


@query(
    "assemble_blocks",
    f"""SELECT b.block_num, b.evm_block_num, CAST(epoch(b.ts) AS BIGINT) AS epoch, b.native_hash, b.receipts_root,
               CAST(coalesce(t.gas, 0) AS BIGINT) AS gas_used, 2147483647::BIGINT AS gas_limit,
               CAST(coalesce(t.size, 0) AS BIGINT) AS size, coalesce(o.logs_bloom, repeat('0', 512)) AS logs_bloom,
               coalesce(t.n, 0) AS tx_count, b.segment
        FROM v_blocks b
        LEFT JOIN (SELECT block, sum(gasused) AS gas, sum(part) AS size, count(*) AS n FROM v_tx GROUP BY block) t
          ON t.block = b.evm_block_num
        LEFT JOIN v_bloom o ON o.block = b.evm_block_num""",
    (V.V_BLOCKS, V.V_TX, V_BLOOM),
)
def assemble_blocks(spark, folder):
    headers = V.blocks(spark, folder).select(
        "block_num", "ts", "native_hash", "evm_hash", "evm_prev_hash", "receipts_root", "transactions_root"
    )
    txs = _with_bloom(V.transactions(spark, folder))
    made = totals.assemble_blocks(headers, txs, V.DELTA, F.col("part"), V.PER_SEGMENT)
    return made.select(
        "block_num",
        "evm_block_num",
        F.unix_seconds("ts").alias("epoch"),
        "native_hash",
        "receipts_root",
        F.col("gas_used").cast("bigint").alias("gas_used"),
        F.col("gas_limit").cast("bigint").alias("gas_limit"),
        "size",
        "logs_bloom",
        "tx_count",
        "segment",
    )


# --- feed -----------------------------------------------------------------------


HEAD_JSON = """'{"type":"head","data":{"difficulty":"0x0","extraData":"0x' || b.native_hash
  || '","gasLimit":"0x7fffffff","miner":"0x0000000000000000000000000000000000000000","nonce":"0x0000000000000000",'
  || '"parentHash":"0x' || b.evm_prev_hash || '","receiptsRoot":"0x' || b.receipts_root
  || '","sha3Uncles":"0x1dcc4de8dec75d7aab85b567b6ccd41ad312451b948a7413f0a142fd40d49347",'
  || '"stateRoot":"56e81f171bcc55a6ff8345e692c0f86e5b48e01b996cadc001622fb5e363b421","transactionsRoot":"0x'
  || b.transactions_root || '","hash":"0x' || b.evm_hash || '","gasUsed":"0x' || lower(to_hex(coalesce(t.gas, 0)))
  || '","logsBloom":"0x' || repeat('0', 512) || '","number":"0x' || lower(to_hex(b.evm_block_num))
  || '","timestamp":"0x' || lower(to_hex(CAST(epoch(b.ts) AS BIGINT))) || '"}}'"""


@query(
    "head_feed",
    f"""SELECT 'raw' AS type, block, trx_index, '{{"type":"raw","data":{{"block":' || block || ',"trx_index":' || trx_index
               || ',"hash":"' || hash || '","gasusedblock":' || gas || '}}}}' AS message
        FROM (SELECT *, CAST(sum(gasused) OVER (PARTITION BY block ORDER BY trx_index) AS BIGINT) AS gas FROM v_tx)
        UNION ALL
        SELECT 'head', b.evm_block_num, -1, {HEAD_JSON}
        FROM v_blocks b LEFT JOIN (SELECT block, CAST(sum(gasused) AS BIGINT) AS gas FROM v_tx GROUP BY block) t
          ON t.block = b.evm_block_num""",
    (V.V_BLOCKS, V.V_TX),
)
def head_feed(spark, folder):
    blocks = V.blocks(spark, folder).withColumn("logs_bloom", F.lit("0" * 512))
    ranked = V.indexed(spark, folder, gasusedblock=F.col("gasused")).select("block", "trx_index", "hash", "gasusedblock")
    # Messages and heads both read the ranked transactions: written once, they are ranked once. One half of the blocks
    # is shuffled at a time, and its shuffle is gone before the next.
    path = f"{shared_folder(spark)}/query-{uuid.uuid4().hex}"
    half = F.pmod(F.xxhash64("block"), F.lit(2))
    with shuffles_dropped(spark):
        for n in range(2):
            ranked.where(half == n).write.mode("append").option("compression", tables.COMPRESSION).parquet(path)
    messages = feed.head_feed(blocks, spark.read.schema(ranked.schema).parquet(path), slices=4)
    return messages.withColumn("trx_index", F.coalesce("trx_index", F.lit(-1)))


# --- rates ----------------------------------------------------------------------


@query(
    "arrival_rate",
    """SELECT slot + 300 * i - 3300 AS window_start, count(*) AS n, CAST(count(*) AS DOUBLE) / 3600 AS per_second
       FROM (SELECT CAST(floor(epoch(ts) / 300) AS BIGINT) * 300 AS slot FROM events), (SELECT unnest(range(12)) AS i)
       GROUP BY 1""",
)
def arrival_rate(spark, folder):
    return rates.arrival_rate(V.arrivals(spark, folder), "1 hour", "5 minutes")


@query(
    "stalls",
    """SELECT arrival_seq, prev AS stalled_from, sec - prev AS stalled_for
       FROM (SELECT arrival_seq, sec, lag(sec) OVER (ORDER BY arrival_seq) AS prev
             FROM (SELECT event_id AS arrival_seq, CAST(floor(epoch(ts)) AS BIGINT) AS sec FROM events))
       WHERE sec - prev > 60""",
)
def stalls(spark, folder):
    return rates.stalls(V.arrivals(spark, folder), 60)


@query(
    "eta",
    "SELECT max(n) AS last, 1000000 - max(n) AS blocks_left, (1000000 - max(n)) / 4.0::DOUBLE AS eta_seconds FROM v_arrivals",
    (V.V_ARRIVALS,),
)
def eta(spark, folder):
    return rates.eta(V.arrivals(spark, folder), 1_000_000, 4.0)


@query(
    "eta_measured",
    """SELECT last, 1000000 - last AS blocks_left, (1000000 - last) / (recent / 10.0::DOUBLE) AS eta_seconds
       FROM (SELECT max(n) AS last, count(*) FILTER (WHERE s > newest - 10) AS recent
             FROM (SELECT n, CAST(floor(epoch(ts)) AS BIGINT) AS s,
                          max(CAST(floor(epoch(ts)) AS BIGINT)) OVER () AS newest FROM v_arrivals))""",
    (V.V_ARRIVALS,),
)
def eta_measured(spark, folder):
    """At the rate of the last ten seconds that have arrivals behind them."""
    return rates.eta(V.arrivals(spark, folder), 1_000_000)


@query(
    "resume_point",
    f"""SELECT g + {V.DELTA} AS start_block, sha256(CAST(g - 1 AS VARCHAR)) AS prev_hash, 'gap' AS source
        FROM (SELECT min(last_before) AS g FROM ({GAPS_SQL}))""",
)
def resume_point(spark, folder):
    found = integrity.gaps(V.transactions(spark, folder), "block")
    return rates.resume_point(V.blocks(spark, folder), found, V.DELTA, 36, purge_gaps=True)
