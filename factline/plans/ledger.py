"""The ledger: movements of accounts to balances and cashflow.

Movements have account_key, date, type (INFLOW, OUTFLOW, OPENING), amount; accounts have account_key, account_type, currency, status.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factline.operators.relational import conditional_sums, running_sum

MONEY = "decimal(20,2)"


def signed_amount(kind: Column, account_type: Column, amount: Column) -> Column:
    """Inflows add and outflows take; credit accounts the other way round; openings as they are."""
    direction = F.when(kind == "OPENING", 1).when(kind == "INFLOW", 1).otherwise(-1)
    return amount * F.when((account_type == "CREDIT") & (kind != "OPENING"), -direction).otherwise(direction)


def convert(df: DataFrame, rates: DataFrame, amount: str, out: str) -> DataFrame:
    """Amounts in the base currency; null where there is no rate. ``rates`` is a small reviewed table."""
    return df.join(rates, "currency", "left").withColumn(out, F.round(F.col(amount) * F.col("rate"), 2).cast(MONEY)).drop("rate")


def effective_transactions(settled: DataFrame, pending: DataFrame, key: str = "id") -> DataFrame:
    """Settled ones, and pending ones that haven't been settled."""
    return settled.unionByName(pending.join(settled.select(key), key, "left_anti"))


def split_amount(amount: Column, share: Column) -> tuple[Column, Column]:
    """Own and shared parts, each rounded by itself."""
    return F.round(amount * share, 2).cast(MONEY), F.round(amount * (1 - share), 2).cast(MONEY)


def resolve_movements(movements: DataFrame, accounts: DataFrame) -> DataFrame:
    """Movements with their account and signed amount; unknown accounts are kept with nulls."""
    joined = movements.join(accounts, "account_key", "left")
    return joined.withColumn("signed", signed_amount(F.col("type"), F.col("account_type"), F.col("amount")).cast(MONEY))


def in_scope(movements: DataFrame, start: Column, as_of: Column) -> DataFrame:
    """Movements from start to as_of, and not before the account's first opening unless they are openings."""
    opened = movements.where(F.col("type") == "OPENING").groupBy("account_key").agg(F.min("date").alias("__opened"))
    joined = movements.join(opened, "account_key", "left")
    return joined.where(F.col("date").between(start, as_of) & ((F.col("type") == "OPENING") | F.col("__opened").isNull() | (F.col("date") >= F.col("__opened")))).drop("__opened")


def account_dates(accounts: DataFrame, movements: DataFrame, as_of: Column) -> DataFrame:
    """Every date from an account's first movement on; accounts without any get the whole span."""
    first = movements.groupBy("account_key").agg(F.min("date").alias("first"))
    span = movements.agg(F.min("date").alias("start"))
    spans = accounts.join(first, "account_key", "left").crossJoin(F.broadcast(span))
    return spans.withColumn("date", F.explode(F.sequence(F.coalesce("first", "start"), as_of))).drop("first", "start")


def daily_balances(accounts: DataFrame, movements: DataFrame, as_of: Column) -> DataFrame:
    """Balance of each account on every date, and its part in net worth."""
    daily = movements.groupBy("account_key", "date").agg(F.sum("signed").alias("delta"))
    dense = account_dates(accounts, movements, as_of).join(daily, ["account_key", "date"], "left").withColumn("delta", F.coalesce("delta", F.lit(0)).cast(MONEY))
    balanced = running_sum(dense, "delta", "balance", ["date"], ["account_key"])
    return balanced.withColumn("net_worth", F.when(F.col("account_type") == "CREDIT", -F.col("balance")).otherwise(F.col("balance")))


def current_balances(daily: DataFrame) -> DataFrame:
    """Balances on the last date; closed accounts have none."""
    last = daily.agg(F.max("date").alias("date"))
    return daily.join(F.broadcast(last), "date").withColumn("balance", F.when(F.col("status") == "CLOSED", F.lit(0).cast(MONEY)).otherwise(F.col("balance")))


def cashflow(transactions: DataFrame, period: str) -> DataFrame:
    """Gross and net income and expense, savings and their running sum, by month or year. ``transactions``: date, cashflow_type, is_deduction, amount, own_amount."""
    income, expense = F.col("cashflow_type") == "INCOME", F.col("cashflow_type") == "EXPENSE"
    measures = {
        "gross_income": (income & ~F.col("is_deduction"), F.col("amount")),
        "deductions": (F.col("is_deduction"), F.col("amount")),
        "gross_expense": (expense & ~F.col("is_deduction"), F.col("amount")),
        "net_expense": (expense & ~F.col("is_deduction"), F.col("own_amount")),
    }
    sums = conditional_sums(transactions.withColumn("period", F.trunc("date", period)), ["period"], measures)
    sums = sums.withColumn("net_income", F.col("gross_income") - F.col("deductions")).withColumn("savings", F.col("net_income") - F.col("net_expense"))
    return running_sum(sums, "savings", "running_savings", ["period"])


def period_rollup(transactions: DataFrame, period: str, dims: list[str], amount: str = "amount") -> DataFrame:
    """Count and sum by period and dimensions, whose values may be null."""
    return transactions.withColumn("period", F.trunc("date", period)).groupBy("period", *dims).agg(F.count(F.lit(1)).alias("n"), F.sum(amount).alias("total"))


#: The type that is paid out of a salary, and what direction a movement has.
SALARY, SALARY_DEDUCTION, TAX = "SALARY", "SALARY DEDUCTION", "TAX"


def classify(transactions: DataFrame, seed: DataFrame) -> DataFrame:
    """``transactions`` with the upper-cased type's cashflow_type and is_deduction; ``seed`` is a small reviewed table by type. Unknown types stay, with nulls."""
    typed = transactions.withColumn("type", F.upper(F.nullif(F.trim("type"), F.lit(""))))
    return typed.join(seed.select("type", "cashflow_type", "is_deduction"), "type", "left")


def salary_accounts(transactions: DataFrame) -> DataFrame:
    """(month, payer, salary_account): the account that a payer's salary went to in a month. Two accounts in a month are two rows."""
    paid = transactions.where((F.col("type") == SALARY) & F.col("payment_source").isNotNull() & F.col("counterparty").isNotNull())
    return paid.select(F.trunc("date", "month").alias("month"), F.col("payment_source").alias("payer"), F.col("counterparty").alias("salary_account")).distinct()


def transaction_entries(transactions: DataFrame) -> DataFrame:
    """Entries (id, source, date, account, direction, amount) of classified transactions that name an account.

    Income goes to the counterparty. Deductions from a salary come off the account that the payer's salary of the month
    went to, other deductions off the counterparty, expenses off the payment source. Null amounts make no entry.
    """
    is_salary_deduction = F.col("type") == SALARY_DEDUCTION
    accounts = salary_accounts(transactions).withColumnsRenamed({"month": "__month", "payer": "__payer"})
    on = is_salary_deduction & (F.trunc("date", "month") == F.col("__month")) & (F.col("counterparty") == F.col("__payer"))
    joined = transactions.where("amount IS NOT NULL").join(accounts, on, "left")
    income, expense = F.col("cashflow_type") == "INCOME", F.col("cashflow_type") == "EXPENSE"
    account = F.when(income, F.col("counterparty")).when(expense & is_salary_deduction, F.col("salary_account")).when(expense & F.col("is_deduction"), F.col("counterparty")).when(expense & ~F.col("is_deduction"), F.col("payment_source"))
    out = joined.select("id", "source", F.col("posted").alias("date"), account.alias("account_key"), F.when(income, "INCREASE").otherwise("DECREASE").alias("direction"), "amount")
    return out.where("account_key IS NOT NULL")


def movement_entries(transactions: DataFrame, paid_for_others: DataFrame, transfers: DataFrame) -> DataFrame:
    """Entries of all four sources: classified transactions, what was paid for others, and transfers out and in, with openings.

    ``paid_for_others``: id, date, payment_source, amount. ``transfers``: id, date, type (OPENING BALANCE, TRANSFER, INFLOW, OUTFLOW),
    source_account, source_amount, destination_account, destination_amount. Sides without an account or an amount make no entry.
    """
    entry = lambda df, source, account, direction, amount: df.select("id", source.alias("source"), "date", F.col(account).alias("account_key"), direction.alias("direction"), F.col(amount).alias("amount"))
    lent = entry(paid_for_others, F.lit("PAID_FOR_OTHERS"), "payment_source", F.lit("DECREASE"), "amount")
    out = entry(transfers.where(F.col("type").isin("TRANSFER", "OUTFLOW")), F.col("type"), "source_account", F.lit("DECREASE"), "source_amount")
    into = entry(transfers.where(F.col("type").isin("OPENING BALANCE", "TRANSFER", "INFLOW")), F.col("type"), "destination_account", F.when(F.col("type") == "OPENING BALANCE", "OPENING").otherwise("INCREASE"), "destination_amount")
    rest = lent.unionByName(out).unionByName(into).where("account_key IS NOT NULL AND amount IS NOT NULL")
    return transaction_entries(transactions).unionByName(rest)


def signed_entry(direction: Column, account_type: Column, amount: Column) -> Column:
    """What an entry adds to a balance: increases add and decreases take, on credit accounts the other way round; openings as they are."""
    kind = F.when(direction == "OPENING", "OPENING").when(direction == "INCREASE", "INFLOW").otherwise("OUTFLOW")
    return signed_amount(kind, F.coalesce(account_type, F.lit("")), amount)


def balance_movements(entries: DataFrame, accounts: DataFrame, start: Column, as_of: Column) -> DataFrame:
    """Entries with their account and signed amount, from ``start`` to ``as_of`` and from the account's first opening on; unknown accounts are kept with nulls."""
    typed = entries.withColumn("type", F.when(F.col("direction") == "OPENING", "OPENING").otherwise(F.col("direction")))
    joined = in_scope(typed, start, as_of).join(accounts, "account_key", "left")
    return joined.withColumn("signed", signed_entry(F.col("direction"), F.col("account_type"), F.col("amount"))).drop("type")


def transactions_mart(transactions: DataFrame) -> DataFrame:
    """Classified transactions with their month."""
    return transactions.withColumn("month", F.trunc("date", "month"))


def income_by_type_source(transactions: DataFrame) -> DataFrame:
    """Gross and net income by month, type and source. Deductions from salaries count under SALARY and their payer, TAX under INTEREST and the source it was paid from."""
    rows = transactions_mart(transactions).where((F.col("cashflow_type") == "INCOME") | F.col("is_deduction"))
    income, cut, tax = F.col("cashflow_type") == "INCOME", F.col("type") == SALARY_DEDUCTION, F.col("type") == TAX
    kind = F.when(income, F.col("type")).when(cut, SALARY).when(tax, "INTEREST").otherwise(F.col("type"))
    source = F.when(income, F.col("payment_source")).when(cut, F.col("counterparty")).when(tax, F.col("payment_source")).when(F.col("is_deduction"), F.col("counterparty"))
    of_tax = F.coalesce(F.col("item") == TAX, F.lit(False))
    measures = {
        "gross_income": (income, F.col("own_amount")),
        "income_deductions": (F.col("is_deduction"), F.col("own_amount")),
        "salary_deductions": (cut & ~of_tax, F.col("own_amount")),
        "salary_tax": (cut & of_tax, F.col("own_amount")),
        "interest_tax": (tax, F.col("own_amount")),
    }
    sums = conditional_sums(rows.withColumns({"income_type": kind, "income_source": source}), ["month", "income_type", "income_source"], measures)
    return sums.withColumns({"tax": F.col("salary_tax") + F.col("interest_tax"), "net_income": F.col("gross_income") - F.col("income_deductions")})


def income_by_source(by_type: DataFrame) -> DataFrame:
    """Gross and net income by month and source, rolled up from :func:`income_by_type_source`."""
    return by_type.groupBy("month", "income_source").agg(F.sum("gross_income").alias("gross_income"), F.sum("net_income").alias("net_income"))


def expenses_by_item(transactions: DataFrame) -> DataFrame:
    """Own expenses other than deductions by month, item, merchant and payment source."""
    rows = transactions_mart(transactions).where((F.col("cashflow_type") == "EXPENSE") & ~F.col("is_deduction"))
    return rows.groupBy("month", "item", "merchant", "payment_source").agg(F.count(F.lit(1)).alias("n"), F.sum("own_amount").alias("net_expense"))
