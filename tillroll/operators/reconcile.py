"""B8 order-total reconciliation and B9 statement balances.

Money is carried as decimals end to end. The child side is always reduced
to one row per parent key *before* the join (partial aggregation in every
task), so a parent with a huge number of children costs one row in the
shuffle that feeds the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.money import MONEY_SUM
from tillroll.operators.quality import RowRule

# Reconciliation outcomes, and the statement's entry types.
STATUS_OK, STATUS_MISMATCH, STATUS_NO_ITEMS = "ok", "mismatch", "no_items"
DEBIT, CREDIT = "DEBITO", "CREDITO"


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def reconcile_orders(
    headers: DataFrame,
    items: DataFrame,
    header_key: str,
    declared: str | Column,
    item_key: str,
    amount: str | Column,
) -> DataFrame:
    """One row per header: ``declared``, ``computed`` (sum of item amounts,
    0 when the header has no items), ``difference`` and ``status``.

    Amounts are summed exactly as decimals and reported as decimal(18, 2).
    """
    per_order = items.groupBy(F.col(item_key).alias("_k")).agg(
        F.sum(_col(amount)).alias("_sum"), F.count(F.lit(1)).alias("_items")
    )
    h = headers.select(F.col(header_key), _col(declared).cast(MONEY_SUM).alias("declared"))
    j = h.join(per_order, h[header_key] == per_order["_k"], "left")
    computed = F.coalesce(F.col("_sum"), F.lit(0)).cast(MONEY_SUM)
    diff = (F.col("declared") - computed).cast(MONEY_SUM)
    return j.select(
        F.col(header_key),
        F.col("declared"),
        computed.alias("computed"),
        diff.alias("difference"),
        F.when(F.col("_items").isNull(), F.lit(STATUS_NO_ITEMS))
        .when(diff == 0, F.lit(STATUS_OK))
        .otherwise(F.lit(STATUS_MISMATCH))
        .alias("status"),
    )


def reconcile_document_total(items: Column, quantity: str, unit_price: str, extra: Column | None,
                             total: Column) -> Column:
    """Nested form: ``sum(q * p) + extra == total`` inside one document,
    evaluated with ``aggregate`` over the items array (no explode). A NULL item
    list counts as empty and a NULL quantity or price as 0, so a document
    without items mismatches its total unless that is the extra alone."""
    zero = F.lit(0).cast("decimal(38,2)")
    summed = F.aggregate(
        F.coalesce(items, F.array()), zero,
        lambda acc, x: (acc + F.coalesce(x[quantity], F.lit(0)) * F.coalesce(x[unit_price], F.lit(0))
                        ).cast("decimal(38,2)"),
    )
    if extra is not None:
        summed = summed + F.coalesce(extra, F.lit(0))
    return summed.cast(MONEY_SUM) == total.cast(MONEY_SUM)


def reconcile_documents(docs: DataFrame, key: str, items: str, quantity: str, unit_price: str,
                        total: str | Column, extra: str | Column | None = None) -> DataFrame:
    """B8 over order documents: the columns of ``reconcile_orders`` per ``key``,
    with computed = sum of quantity x price over the item array + ``extra``
    (freight; NULL is 0). Items are summed inside each document; an order dealt
    over several documents (``nest``) is added up, its total and ``extra``
    repeated on each and counted once. Documents without a key count as one."""
    summed = F.aggregate(
        F.coalesce(F.col(items), F.array()), F.lit(0).cast("decimal(38,2)"),
        lambda acc, x: (acc + F.coalesce(x[quantity], F.lit(0)) * F.coalesce(x[unit_price], F.lit(0))
                        ).cast("decimal(38,2)"),
    )
    parts = docs.select(
        F.col(key), _col(total).cast(MONEY_SUM).alias("declared"),
        (F.lit(0) if extra is None else F.coalesce(_col(extra), F.lit(0))).cast(MONEY_SUM).alias("_extra"),
        summed.alias("_sum"), F.size(F.coalesce(F.col(items), F.array())).alias("_items"),
    )
    whole = parts.groupBy(key).agg(F.max("declared").alias("declared"), F.max("_extra").alias("_extra"),
                                   F.sum("_sum").alias("_sum"), F.sum("_items").alias("_items"))
    computed = (F.col("_sum") + F.col("_extra")).cast(MONEY_SUM)
    diff = (F.col("declared") - computed).cast(MONEY_SUM)
    status = (F.when(F.col("_items") == 0, F.lit(STATUS_NO_ITEMS)).when(diff == 0, F.lit(STATUS_OK))
              .otherwise(F.lit(STATUS_MISMATCH)))
    return whole.select(F.col(key), "declared", computed.alias("computed"), diff.alias("difference"),
                        status.alias("status"))


def signed_amount(value: str | Column, kind: str | Column) -> Column:
    """Amounts stored without a sign: debits count negative, credits positive;
    other kinds are not entries."""
    v, k = _col(value), _col(kind)
    return F.when(k == DEBIT, -F.abs(v)).when(k == CREDIT, F.abs(v))


def wrong_sign_rule(value: str, kind: str) -> RowRule:
    """A debit stored above zero, or a credit below."""
    v, k = F.col(value), F.col(kind)
    return RowRule("wrong_sign", value, F.coalesce(((k == DEBIT) & (v > 0)) | ((k == CREDIT) & (v < 0)), F.lit(False)))


def balance_by_account(
    accounts: DataFrame,
    account_key: str,
    opening: str | Column,
    entries: DataFrame,
    entry_key: str,
    value: str | Column,
    kind: str | Column,
) -> DataFrame:
    """Per account: opening, credits, debits, closing = opening + credits + debits.

    Entries are aggregated per account first (map-side combine), then left
    joined, so an account without entries keeps closing = opening. Amounts count
    with their stored sign, as in ``statement_balances``; ``wrong_sign_rule``
    finds entries whose sign contradicts their kind.
    """
    signed = _col(value).cast(MONEY_SUM)
    per = entries.groupBy(F.col(entry_key).alias("_k")).agg(
        F.sum(F.when(_col(kind) == CREDIT, signed)).alias("_cr"),
        F.sum(F.when(_col(kind) == DEBIT, signed)).alias("_db"),
    )
    a = accounts.select(F.col(account_key), _col(opening).cast(MONEY_SUM).alias("opening"))
    j = a.join(per, a[account_key] == per["_k"], "left")
    cr = F.coalesce(F.col("_cr"), F.lit(0)).cast(MONEY_SUM)
    db = F.coalesce(F.col("_db"), F.lit(0)).cast(MONEY_SUM)
    return j.select(
        F.col(account_key), "opening",
        cr.alias("credits"), db.alias("debits"),
        (F.col("opening") + cr + db).cast(MONEY_SUM).alias("closing"),
    )


def statement_balances(statements: DataFrame, key: str = "id_extrato") -> DataFrame:
    """Nested statements: opening + sum of signed transaction values vs the
    closing balance stated in the document, per statement, without explode."""
    zero = F.lit(0).cast("decimal(38,2)")
    moved = F.aggregate(
        F.coalesce(F.col("transacoes"), F.array()), zero,
        lambda acc, t: (acc + F.coalesce(t["valor"], F.lit(0))).cast("decimal(38,2)"),
    )
    expected = (F.col("saldos.saldo_anterior") + moved).cast(MONEY_SUM)
    return statements.select(
        F.col(key),
        F.col("saldos.saldo_anterior").cast(MONEY_SUM).alias("opening"),
        moved.cast(MONEY_SUM).alias("movement"),
        F.col("saldos.saldo_atual").cast(MONEY_SUM).alias("closing"),
        (expected == F.col("saldos.saldo_atual").cast(MONEY_SUM)).alias("balanced"),
    )


def totals_by_type(entries: DataFrame, keys: list[str], kind: str, value: str | Column) -> DataFrame:
    """Entry count and exact decimal total per ``keys + kind``."""
    return entries.groupBy(*keys, kind).agg(
        F.count(F.lit(1)).alias("entries"),
        F.sum(_col(value).cast(MONEY_SUM)).cast(MONEY_SUM).alias("total"),
    )
