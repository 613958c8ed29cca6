"""Every registered query and the SQL that it must agree with."""

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator: adds a (spark, sf_dir) -> DataFrame query, with its oracle where SQL has one."""

    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add
