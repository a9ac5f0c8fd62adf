"""Wide customer feature table (inventory A8, built from A2-A7, J1, J2, P12, F6, F7).

Input grains: customers (one row per client), accounts (one row per account,
with its owner and account type) and transactions (one row per movement,
with account, type and amount).

Plan, chosen for scale:

1. transactions are aggregated per account first (partial aggregation in
   every map task, then one shuffle on the account key). This collapses the
   largest table before any join, and a hot account costs one partial row per
   task instead of one task per account;
2. the per-account rows are left-joined to accounts (J1) - one row each side
   per account, so the join cannot fan out;
3. accounts are aggregated per customer (second shuffle, on the customer key,
   again with partial aggregation);
4. customers are left-joined and NULLs coalesced to 0 (J2, P12).

The account table is joined once; the reference joins it three times.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.aggregate import count_when

# Output column names of the reference feature table, in its order.
AGE = "eta"
N_OUT = "numero_transazioni_in_uscita"
N_IN = "numero_transazioni_in_entrata"
AMT_OUT = "importo_transazioni_in_uscita"
AMT_IN = "importo_transazioni_in_entrata"
N_ACCOUNTS = "numero_di_conti"
ACCOUNT_TYPE_COUNTS = ["tipo_conto_base", "tipo_conto_business", "tipo_conto_privati",
                       "tipo_conto_famiglie"]
TXN_TYPE_COUNTS_OUT = ["trans_uscita_Acquisto_su_Amazon", "trans_uscita_Rata_mutuo",
                       "trans_uscita_Hotel", "trans_uscita_Biglietto_aereo",
                       "trans_uscita_Supermercato"]
TXN_TYPE_COUNTS_IN = ["trans_entrata_Stipendio", "trans_entrata_Pensione",
                      "trans_entrata_Dividendi"]
ACCOUNT_TYPE_SUFFIX = ["ContoBase", "ContoBusiness", "ContoPrivati", "ContoFamiglie"]
# Transaction type codes 0-2 are incoming, 3-7 outgoing; account types 0-3.
IN_TYPES = (0, 1, 2)
OUT_TYPES = (3, 4, 5, 6, 7)
ACCOUNT_TYPES = (0, 1, 2, 3)


def amount_cols() -> list[str]:
    out = []
    for suffix in ACCOUNT_TYPE_SUFFIX:
        out += [f"importo_entrata_{suffix}", f"importo_uscita_{suffix}"]
    return out


def output_columns(id_col: str = "id_cliente") -> list[str]:
    return ([id_col, AGE, N_OUT, N_IN, AMT_OUT, AMT_IN, N_ACCOUNTS] + ACCOUNT_TYPE_COUNTS
            + TXN_TYPE_COUNTS_OUT + TXN_TYPE_COUNTS_IN + amount_cols())


def whole_years(start: Column, end: Column) -> Column:
    """Age in whole years, as SQL ``timestampdiff(YEAR, start, end)``.

    Not ``months_between / 12``: that differs on 29 February.
    """
    return F.timestamp_diff("YEAR", start, end)


def customer_features(customers: DataFrame, accounts: DataFrame, transactions: DataFrame,
                      as_of, *, customer_id: str = "id_cliente", birth_date: str = "data_nascita",
                      account_id: str = "id_conto", account_type: str = "id_tipo_conto",
                      txn_type: str = "id_tipo_trans", amount: str = "importo",
                      in_types: Sequence[int] = IN_TYPES, out_types: Sequence[int] = OUT_TYPES,
                      account_types: Sequence[int] = ACCOUNT_TYPES,
                      amount_type: str = "decimal(28,2)") -> DataFrame:
    """Build the 27-column behavioural table, one row per customer."""
    as_of_col = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")
    t_type = F.col(txn_type)
    amt = F.col(amount).cast(amount_type)
    is_in = t_type.isin(*in_types)
    is_out = t_type.isin(*out_types)
    zero = F.lit(0).cast(amount_type)

    # 1. per account: counts per direction and per type, amounts per direction
    per_account = transactions.groupBy(account_id).agg(
        count_when(is_in).alias("_n_in"),
        count_when(is_out).alias("_n_out"),
        F.sum(F.when(is_in, amt).otherwise(zero)).alias("_a_in"),
        F.sum(F.when(is_out, amt).otherwise(zero)).alias("_a_out"),
        *[count_when(t_type == k).alias(f"_t{k}") for k in list(in_types) + list(out_types)],
    )

    # 2. accounts left-join their per-account aggregates
    acc = accounts.select(customer_id, account_id, account_type).join(
        per_account, on=account_id, how="left")

    # 3. per customer
    a_type = F.col(account_type)

    def s(c):  # sum over accounts, NULL (account without transactions) counts as 0
        return F.coalesce(F.sum(F.col(c)), F.lit(0))

    aggs = [
        s("_n_out").cast("bigint").alias(N_OUT),
        s("_n_in").cast("bigint").alias(N_IN),
        F.round(F.coalesce(F.sum("_a_out"), zero), 2).cast(amount_type).alias(AMT_OUT),
        F.round(F.coalesce(F.sum("_a_in"), zero), 2).cast(amount_type).alias(AMT_IN),
        F.countDistinct(account_id).alias(N_ACCOUNTS),
    ]
    aggs += [count_when(a_type == k).alias(n) for k, n in zip(account_types, ACCOUNT_TYPE_COUNTS)]
    aggs += [s(f"_t{k}").cast("bigint").alias(n) for k, n in zip(out_types, TXN_TYPE_COUNTS_OUT)]
    aggs += [s(f"_t{k}").cast("bigint").alias(n) for k, n in zip(in_types, TXN_TYPE_COUNTS_IN)]
    for k, suffix in zip(account_types, ACCOUNT_TYPE_SUFFIX):
        for direction, col in (("entrata", "_a_in"), ("uscita", "_a_out")):
            aggs.append(F.round(F.coalesce(F.sum(F.when(a_type == k, F.col(col))), zero), 2)
                        .cast(amount_type).alias(f"importo_{direction}_{suffix}"))
    per_customer = acc.groupBy(customer_id).agg(*aggs)

    # 4. customers with their age (F6), left-join, coalesce to 0
    # hash-partitioned on the customer key once: the de-duplication of
    # (customer, age) and the join below both reuse that partitioning
    ages = customers.select(
        F.col(customer_id), whole_years(F.col(birth_date), as_of_col).alias(AGE)).repartition(
        customer_id).distinct()
    joined = ages.join(per_customer, on=customer_id, how="left")
    feature_cols = [c for c in output_columns(customer_id) if c not in (customer_id, AGE)]
    out = joined.select(
        customer_id, AGE,
        *[F.coalesce(F.col(c), F.lit(0).cast(joined.schema[c].dataType)).alias(c)
          for c in feature_cols])
    return out
