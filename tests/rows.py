"""Small transaction tables for tests."""

from txnloom.schemas import TXN, TXN_COLUMNS

_BLANK = {"step": 1, "type": "PAYMENT", "amount": 10.0, "nameOrig": "C1", "oldbalanceOrg": 0.0,
          "newbalanceOrig": 1000.0, "nameDest": "M1", "oldbalanceDest": 0.0, "newbalanceDest": 1.0,
          "isFraud": 0, "isFlaggedFraud": 0, "txnId": None, "ingest_ts": None}


def txns(spark, rows):
    """DataFrame from dicts that name only what matters."""
    full = [tuple({**_BLANK, **r}[c] for c in TXN_COLUMNS) for r in rows]
    return spark.createDataFrame(full, TXN)


def by(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}
