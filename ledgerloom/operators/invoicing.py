"""Invoice totals, postings, credit notes and posting completeness."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import MONEY_TOTAL, total, zero
from ledgerloom.functions.skew import join_hot


def _line_amount():
    return (F.col("qty") * F.col("unit_price")).cast(MONEY_TOTAL)


def checked_lines(lines: DataFrame) -> DataFrame:
    """Invoice lines with a flag saying that amount is quantity times price."""
    return lines.withColumn("amount_ok", F.coalesce(F.col("amount").cast(MONEY_TOTAL) == _line_amount(), F.lit(False)))


def invoice_totals(lines: DataFrame) -> DataFrame:
    """Lines and total per invoice, and whether every line amount is right."""
    return checked_lines(lines).groupBy("invoice_id").agg(
        F.count(F.lit(1)).alias("lines"), total("amount").alias("total"), F.bool_and("amount_ok").alias("amount_ok")
    )


def invoice_postings(
    invoices: DataFrame,
    lines: DataFrame,
    receivable_account: int,
    revenue_account: int,
    dims: list[str] | None = None,
    prefix: str = "INV-",
) -> tuple[DataFrame, DataFrame]:
    """Journal entries and lines for issued invoices.

    Receivables are debited with the invoice total, revenue is credited line by line.
    With ``dims`` both carry those columns of the invoice lines, and the entry balances
    within each combination of them.
    """
    dims = dims or []
    issued = invoices.filter("status = 'issued'")
    entry_id = F.concat(F.lit(prefix), F.col("invoice_id").cast("string")).alias("entry_id")
    entries = issued.select(
        entry_id, F.col("issued_at").alias("entry_date"), F.lit("invoice").alias("source_type"),
        F.col("invoice_id").alias("source_id"), F.lit("draft").alias("status"),
    )
    # A hash of the few narrow ids instead of a sort of all lines: the memory of a task is that of its ids.
    billed = lines.join(issued.select("invoice_id").hint("shuffle_hash"), "invoice_id", "left_semi")
    revenue = billed.select(
        entry_id, F.lit(revenue_account).alias("account_id"), *dims, zero().alias("debit"),
        F.col("amount").cast(MONEY_TOTAL).alias("credit"),
    )
    receivable = billed.groupBy("invoice_id", *dims).agg(total("amount").alias("debit")).select(
        entry_id, F.lit(receivable_account).alias("account_id"), *dims, "debit", zero().alias("credit")
    )
    return entries, receivable.unionByName(revenue)


def credit_notes(
    invoices: DataFrame, lines: DataFrame, voids: DataFrame, prefix: str = "CN-"
) -> tuple[DataFrame, DataFrame]:
    """Credit notes that take back invoices without touching them.

    ``voids`` has a column invoice_id. Only invoices that were issued, void ones included,
    get a credit note; its lines repeat the invoice lines with negative quantity.
    """
    voided = invoices.filter("status in ('issued', 'void')").join(
        voids.select("invoice_id").distinct(), "invoice_id", "left_semi"
    )
    note_id = F.concat(F.lit(prefix), F.col("invoice_id").cast("string")).alias("credit_note_id")
    notes = voided.select(note_id, F.col("invoice_id").alias("credits_invoice_id"), "customer_id")
    rest = [c for c in lines.columns if c not in ("invoice_id", "qty", "amount")]
    note_lines = join_hot(lines, voided.select("invoice_id"), ["invoice_id"], "left_semi").select(
        note_id, *rest, (-F.col("qty")).alias("qty"), (-F.col("amount")).alias("amount")
    )
    return notes, note_lines


def posting_completeness(source_events: DataFrame, entries: DataFrame) -> DataFrame:
    """Events without a posting or with several.

    ``source_events`` has source_type and source_id; entries are matched by the same columns.
    """
    key = ["source_type", "source_id"]
    postings = entries.groupBy(*key).agg(F.count(F.lit(1)).alias("postings"))
    n = F.coalesce("postings", F.lit(0))
    return (
        source_events.select(*key).distinct().join(postings, key, "left")
        .select(*key, n.alias("postings"), F.when(n == 0, "missing").when(n > 1, "duplicate").alias("problem"))
        .filter("problem is not null")
    )
