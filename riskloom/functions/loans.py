"""Month on book, missed instalments, days past due and the default label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_on_book(installment: Column | str = "installment_num") -> Column:
    return F.col(installment).try_cast("int") if isinstance(installment, str) else installment.try_cast("int")


def installments_missed(
    overdue: Column | str = "overdue_amt", due: Column | str = "due_amt", exact: bool = False
) -> Column:
    """Instalments covered by the overdue amount, rounded up; 0 when it cannot be said.

    The operands are 32-bit amounts divided in 64 bits, so representation noise may
    push an exact multiple one up (60.9 / 20.3 gives 4). That is the established
    definition; ``exact=True`` divides cents instead and gives 3.
    """
    overdue, due = (F.col(c) if isinstance(c, str) else c for c in (overdue, due))
    if exact:
        overdue, due = overdue.try_cast("decimal(18,2)"), due.try_cast("decimal(18,2)")
    return F.coalesce(F.ceil(F.try_divide(overdue, due)).try_cast("int"), F.lit(0))


def first_missed_date(
    snapshot: Column | str = "snapshot_date", missed: Column | str = "installments_missed"
) -> Column:
    """Snapshot moved back one month per missed instalment; NULL when none was missed."""
    missed = F.col(missed) if isinstance(missed, str) else missed
    return F.when(missed > 0, F.add_months(snapshot, -missed))


def days_past_due(
    overdue: Column | str = "overdue_amt",
    snapshot: Column | str = "snapshot_date",
    first_missed: Column | str = "first_missed_date",
) -> Column:
    """Days since the first missed date; 0 if nothing is owed, NULL if owed without a date."""
    overdue = F.col(overdue) if isinstance(overdue, str) else overdue
    return F.when(overdue > 0, F.date_diff(snapshot, first_missed)).otherwise(F.lit(0))


def label(dpd: int = 30, column: Column | str = "dpd") -> Column:
    """1 from ``dpd`` days past due on. Unknown days count as not defaulted."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce((column >= dpd).cast("int"), F.lit(0))


def label_definition(dpd: int = 30, mob: int = 6) -> Column:
    return F.lit(f"{dpd}dpd_{mob}mob")
