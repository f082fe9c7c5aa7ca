"""Adding newly read advisories to the dataset."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vulnloom.functions.text import id_year, strip
from vulnloom.operators.index import RANK_BLOCK, SORTED_LIMIT
from vulnloom.operators.running import running_total
from vulnloom.schema import RAW_COLUMNS

# Words of 64 bits of an id filter, at least and at most, and ids a word is meant for.
MIN_WORDS = 1 << 10
MAX_WORDS = 1 << 20
IDS_PER_WORD = 4
# More years than this are not used to prune partitions.
MAX_YEARS = 500


def done_ids(existing: DataFrame) -> DataFrame:
    """The distinct ids already in the dataset."""
    return (
        existing.select(strip(F.col("cve_id")).alias("cve_id")).filter("cve_id <> ''").distinct()
    )


def pending_ids(ids: DataFrame, done: DataFrame) -> DataFrame:
    """Listed ids, trimmed, that are not in the dataset, each at its first position."""
    named = ids.withColumn("cve_id", strip(F.col("cve_id"))).filter("cve_id <> ''")
    wanted = named.groupBy("cve_id").agg(F.min("ord").alias("ord"))
    return wanted.join(done, "cve_id", "left_anti")


def with_year(ids: DataFrame) -> DataFrame:
    """Add ``cve_year``, by which lake tables are partitioned; 0 is no known year."""
    return ids.withColumn("cve_year", F.coalesce(id_year(F.col("cve_id")), F.lit(0)))


def in_years_of(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Leave out the partitions of a table by year that hold none of the ids.

    The years are asked for first, so that they prune the scan itself; ids that
    name more years than any calendar prune nothing.
    """
    if "cve_year" not in rows.columns:
        return rows
    years = with_year(ids.select("cve_id")).select("cve_year").distinct()
    found = [r.cve_year for r in years.limit(MAX_YEARS + 1).collect()]
    return rows if len(found) > MAX_YEARS else rows.filter(F.col("cve_year").isin(found))


def _bits(word_bits: Column) -> Column:
    """The four bits of a word that an id sets, from its hash."""
    one = F.lit(1).cast("bigint")
    places = [F.shiftright(word_bits, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(4)]
    bits = [F.call_function("shiftleft", one, place) for place in places]
    return bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2]).bitwiseOR(bits[3])


def filter_words(n_ids: int) -> int:
    """How many words a filter of so many ids has."""
    words = MIN_WORDS
    while words < MAX_WORDS and words * IDS_PER_WORD < n_ids:
        words *= 2
    return words


def may_hold(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose id is among ``ids``, and a few others, found where the rows lie.

    ``ids`` is a written table. Its Bloom filter has rows (_word, _bits): an id is four bits
    of one 64-bit word. There are ``MAX_WORDS`` rows of two numbers at most, however many
    ids, so the filter may always be broadcast; more ids than it is meant for let more
    others through.
    """
    code = F.xxhash64("cve_id")
    word = F.pmod(F.shiftright(code, 32), F.lit(filter_words(ids.count())))
    bits = _bits(code)
    own = {"_word": word, "_own": bits}
    held = ids.withColumns(own).groupBy("_word").agg(F.bit_or("_own").alias("_bits"))
    near = rows.withColumns(own).join(F.broadcast(held), "_word")
    return near.filter(F.col("_bits").bitwiseAND(F.col("_own")) == F.col("_own")).select(*rows.columns)


def wanted_pages(pages: DataFrame, pending: DataFrame) -> DataFrame:
    """The pages whose ids may be pending; give it a written table of pending ids.

    A page is far larger than its id, so it is never moved to be looked up: a Bloom filter
    of the pending ids is tested where the pages lie. The few other pages that pass it are
    left out by ``placed``, after they are read.
    """
    pages = pages.withColumn("cve_id", strip(F.col("cve_id")))
    return may_hold(in_years_of(pages, pending), pending)


def placed(rows: DataFrame, pending: DataFrame) -> DataFrame:
    """Rows of pending ids, with what ``pending`` tells of them; give it narrow rows."""
    own = [c for c in rows.columns if c == "cve_id" or c not in pending.columns]
    return rows.select(*own).join(pending, "cve_id")


def first_success(rows: DataFrame, order: Column, keep: list[str]) -> DataFrame:
    """cve_id and the columns ``keep`` of one accepted row per id, the first by ``order``.

    Give it narrow rows that name their place. Copies of a page are reduced before the
    shuffle, so an id with very many copies costs no more than any other.
    """
    return (
        rows.filter("reject_reason IS NULL")
        .groupBy("cve_id")
        .agg(F.min(F.struct(order.alias("_order"), *keep)).alias("at"))
        .select("cve_id", *[f"at.{c}" for c in keep])
    )


def first_in_order(rows: DataFrame, n: int) -> DataFrame:
    """The ``n`` rows of lowest ``ord``, ties by ``cve_id``, null first.

    A bounded sort, or totals per block where ``n`` is too large for one task; both
    give the same rows.
    """
    if n <= SORTED_LIMIT:
        return rows.orderBy("ord", "cve_id").limit(n)
    return in_ord_order(rows).filter(F.col("_nth") <= n).select(*rows.columns)


def in_ord_order(ids: DataFrame) -> DataFrame:
    """Distinct ids with their 1-based place by (ord, cve_id), as ``_nth``; no task sorts them all."""
    wide = RANK_BLOCK * RANK_BLOCK
    blocked = ids.withColumns(
        {"_wide": F.floor(F.col("ord") / wide), "_block": F.floor(F.col("ord") / RANK_BLOCK)}
    )
    return running_total(blocked, [], [["_wide"], ["_block"]], ["ord", "cve_id"], F.lit(1), "_nth").select(
        *ids.columns, "_nth")


def last_tried(rows: DataFrame, room: int) -> tuple[int, str] | None:
    """(ord, cve_id) of the id whose acceptance fills the room; None where nothing does.

    Found on ids and positions alone.
    """
    firsts = rows.filter("reject_reason IS NULL").groupBy("cve_id").agg(F.min("ord").alias("ord"))
    filling = first_in_order(firsts, room).agg(
        F.count("*").alias("n"), F.max(F.struct("ord", "cve_id")).alias("last")
    ).first()
    return (filling.last.ord, filling.last.cve_id) if filling.n == room else None


def up_to(rows: DataFrame, last: tuple[int, str] | None) -> DataFrame:
    """Rows of ids that come no later than ``last``."""
    if last is None:
        return rows
    ord_, cve_id = F.col("ord"), F.col("cve_id")
    return rows.filter((ord_ < last[0]) | ((ord_ == last[0]) & (cve_id <= last[1])))


def refused(rows: DataFrame) -> DataFrame:
    """One reason for each id of which no page was accepted."""
    reason = F.struct("reject_reason", "reject_detail")
    return (
        rows.groupBy("cve_id")
        .agg(F.count_if(F.col("reject_reason").isNull()).alias("_good"),
             F.min(F.when(F.col("reject_reason").isNotNull(), reason)).alias("_why"))
        .filter("_good = 0")
        .select("cve_id", "_why.*")
    )


def until_target(existing: DataFrame, new: DataFrame, target: int | None = None) -> DataFrame:
    """Existing rows, then new rows in ``ord`` order until the target is met.

    Every existing row counts, repeats included, and none is ever removed.
    """
    if target is not None:
        new = first_in_order(new, max(0, target - existing.count()))
    return existing.unionByName(new.select(*existing.columns))


def run_counters(
    spark: SparkSession,
    ids_available: int,
    existing_rows: int,
    already_collected: int,
    attempted: int,
    successes: int,
    target: int | None,
) -> DataFrame:
    """One row of counts about a run.

    ``existing_rows`` counts repeats, ``already_collected`` distinct ids;
    ``attempted`` ids were pending and tried.
    """
    counts = {
        "ids_available": ids_available,
        "existing_rows": existing_rows,
        "already_collected": already_collected,
        "successes": successes,
        "skipped": attempted - successes,
        "final_rows": existing_rows + successes,
        "target": target,
    }
    return spark.createDataFrame(
        [tuple(counts.values())], ", ".join(f"{name} bigint" for name in counts)
    )
