import duckdb
import pytest


@pytest.fixture
def sql():
    """Run DuckDB SQL over given tables: sql(query, documents=DataFrame, ...)."""

    def run(query, **tables):
        db = duckdb.connect()
        for name, df in tables.items():
            frame = df.toArrow()
            db.register(name, frame)
        cursor = db.execute(query)
        return [d[0] for d in cursor.description], cursor.fetchall()

    return run
