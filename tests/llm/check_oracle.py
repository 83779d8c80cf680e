"""Compare the queries of the text operators with their SQL: ``python tests/llm/check_oracle.py sf0.01 [name...]``."""

import os
import sys
from types import SimpleNamespace

sys.path[:0] = [os.path.join(os.path.dirname(os.path.abspath(__file__)), *up) for up in ((os.pardir,), (os.pardir, os.pardir))]

from oracle import compare, connect  # noqa: E402


def differences(spark, sf_dir, names=()):
    from txnloom.llm.queries import ORACLES, QUERIES
    con = connect(sf_dir)
    return {n: compare(spark, con, SimpleNamespace(plan=QUERIES[n], oracle=sql), sf_dir)
            for n, sql in ORACLES.items() if not names or n in names}


if __name__ == "__main__":
    from txnloom.session import build_session
    session = build_session("oracle", "local[8]", {"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8"})
    session.sparkContext.setLogLevel("ERROR")
    print(differences(session, f"/root/testdata/{sys.argv[1]}", sys.argv[2:]))
