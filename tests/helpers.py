"""Small helpers shared by the tests."""


def rows(df, *order):
    """Rows as tuples, sorted by the given columns (all when none given), NULL first."""
    keys = order or df.columns
    return sorted(
        (tuple(r) for r in df.collect()),
        key=lambda r: tuple((r[df.columns.index(k)] is not None, r[df.columns.index(k)]) for k in keys),
    )


def values(df, *columns):
    row = df.select(*columns).first()
    return tuple(row)


def physical_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """The adapted plan after a run."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
