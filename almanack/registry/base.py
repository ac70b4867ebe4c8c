"""The registry: query name -> Spark callable, and its SQL where SQL can say it."""

QUERIES = {}
ORACLES = {}


def register(name, sql=None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


def with_(*ctes):
    return "WITH " + ",\n".join(ctes) + "\n"
