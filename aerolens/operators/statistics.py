"""Whole-frame statistics as one-row frames, and their use as scalar subqueries.

A one-row result enters another frame as a scalar subquery: Spark runs it first and puts the
value into the generated code, so there is neither a join nor a window over everything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T


def with_scalar(df: DataFrame, one_row: DataFrame, name: str) -> DataFrame:
    """Attach the single row of ``one_row`` to every row of ``df`` as the struct ``name``."""
    return df.withColumn(name, one_row.select(F.struct("*")).scalar())


def _aggregate(df: DataFrame, *expressions: str) -> DataFrame:
    return df.agg(*map(F.expr, expressions))


def summary(df: DataFrame, columns: list[str], probability: float = 0.5, accuracy: int = 10_000) -> DataFrame:
    """One row: ``rows``, and per column a struct of moments and the bracket of a quantile.

    ``percentile_approx`` is off by at most count/accuracy ranks, so asking two such steps below
    and above the wanted one encloses it with a step to spare. Up to ``accuracy`` rows that spare
    step may be less than one rank, and the bracket is the whole range instead.
    """
    step = 2.0 / accuracy
    below, beyond = max(0.0, probability - step), min(1.0, probability + step)

    def described(c: str) -> str:
        value = f"cast({c} as double)"
        sides = f"percentile_approx({value}, array({below}D, {beyond}D), {accuracy})"
        return f"""named_struct(
            'n', count({value}), 'min', min({value}), 'max', max({value}),
            'mean', avg({value}), 'var', var_pop({value}),
            'low', if(count({value}) <= {accuracy}, min({value}), get({sides}, 0)),
            'high', if(count({value}) <= {accuracy}, max({value}), get({sides}, 1))) as {c}"""

    return _aggregate(df, "count(*) as rows", *map(described, columns))


CUTS = 512
_FRACTIONS = f"array({', '.join(f'{i / CUTS!r}D' for i in range(CUTS + 1))})"


def _narrowed(
    df: DataFrame, columns: list[str], brackets: DataFrame, probability: float, accuracy: int = 10_000
) -> DataFrame:
    """One row: per column ``n`` and a narrower bracket, found among the values inside the first one.

    Cuts split those values into ``CUTS`` parts of like size. How many values lie below the first bracket tells
    between which cuts the quantile is; one more cut on either side covers their error.
    """
    inside = {c: f"if({c} >= _b.{c}.low and {c} <= _b.{c}.high, {c}, null)" for c in columns}
    values = df.selectExpr(*[f"cast({c} as double) as {c}" for c in columns])
    scanned = _aggregate(
        with_scalar(values, brackets, "_b"),
        *[
            f"""named_struct('n', max(_b.{c}.n), 'low', max(_b.{c}.low), 'high', max(_b.{c}.high),
                'under', count_if({c} < _b.{c}.low), 'inside', count({part}),
                'cuts', percentile_approx({part}, {_FRACTIONS}, {accuracy})) as {c}"""
            for c, part in inside.items()
        ],
    )

    def narrower(c: str) -> str:
        rank = f"(({c}.n - 1) * {probability}D)"
        first = f"(floor((floor({rank}) - {c}.under) / {c}.inside * {CUTS}) - 1)"
        last = f"(ceil((ceil({rank}) + 1 - {c}.under) / {c}.inside * {CUTS}) + 1)"
        return f"""named_struct('n', {c}.n,
            'low', if({c}.inside = 0 or {first} <= 0, {c}.low, get({c}.cuts, cast({first} as int))),
            'high', if({c}.inside = 0 or {last} >= {CUTS}, {c}.high, get({c}.cuts, cast({last} as int)))) as {c}"""

    return scanned.selectExpr(*map(narrower, columns))


def _quantile_ends(df: DataFrame, columns: list[str], brackets: DataFrame, probability: float) -> DataFrame:
    """One row: per column the two values the quantile lies between, and how far along.

    ``brackets`` has ``n, low, high`` of each column.
    """
    # Rows below the bracket share the value NULL, rows above it are dropped.
    inside = ", ".join(
        f"""if({c} <= _b.{c}.high,
            named_struct('place', {place}, 'n', _b.{c}.n, 'value', if({c} >= _b.{c}.low, {c}, null)), null)"""
        for place, c in enumerate(columns)
    )
    values = df.selectExpr(*[f"cast({c} as double) as {c}" for c in columns])
    counted = (
        with_scalar(values, brackets, "_b")
        .selectExpr(f"inline(array_compact(array({inside})))")
        .groupBy("place", "value")
        .agg(F.expr("count(*) as rows"), F.expr("max(n) as n"))
    )
    rank = f"((n - 1) * {probability}D)"
    reached = counted.selectExpr(
        "place", "value", f"{rank} as rank",
        "sum(rows) over (partition by place order by value asc nulls first) as upto",
    )
    return _aggregate(
        reached,
        *[
            f"""named_struct(
                'floor_value', min(value) filter (where place = {place} and upto > floor(rank)),
                'ceil_value', min(value) filter (where place = {place} and upto > ceil(rank)),
                'part', max(rank - floor(rank)) filter (where place = {place}),
                'below', count_if(place = {place} and value is null and upto > floor(rank)),
                'known', count_if(place = {place})) as {c}"""
            for place, c in enumerate(columns)
        ],
    )


def _between(c: str) -> str:
    """The interpolated quantile. A bracket that does not enclose it would be an error, never a wrong value."""
    missed = f"{c}.below > 0 or ({c}.known > 0 and {c}.ceil_value is null)"
    value = f"{c}.floor_value + ({c}.ceil_value - {c}.floor_value) * {c}.part"
    return f"if({missed}, raise_error('the bracket misses the quantile of {c}'), {value})"


#: The built-in percentile holds so many distinct values of a column in one task at most: some megabytes.
ONE_PASS_ROWS = 100_000
#: Of so many rows about 6/accuracy are inside the first bracket, 60,000 of each column, which one task can sum up.
ONE_BRACKET_ROWS = 100_000_000


def exact_quantiles(
    df: DataFrame, columns: list[str], probability: float = 0.5, accuracy: int = 10_000, rows: int | None = None,
    narrow: bool = True,
) -> DataFrame:
    """One row with the exact, linearly interpolated quantile of each column.

    If ``rows``, their number, is known to be ``ONE_PASS_ROWS`` at most, the built-in percentile takes one pass.
    Up to ``ONE_BRACKET_ROWS`` the second pass below may be left out by ``narrow``; the result is the same.

    The built-in exact percentile keeps every distinct value of the frame in one task. Here a first
    pass finds a narrow bracket around the quantile and a second one a part of that bracket; the third counts the
    rows below it and the distinct values inside it, both before the shuffle, so a value held by a third of all rows
    is one row from there on. About 6/accuracy * 4/CUTS of the rows, one in 200,000, can reach the running sum
    at the end; a frame too large for that has 10**12 rows and more.
    """
    if rows is not None and rows <= ONE_PASS_ROWS:
        return _aggregate(df, *(f"percentile(cast({c} as double), {probability}D) as {c}" for c in columns))
    brackets = summary(df, columns, probability, accuracy)
    if narrow:
        brackets = _narrowed(df, columns, brackets, probability)
    ends = _quantile_ends(df, columns, brackets, probability)
    return ends.selectExpr(*[f"{_between(c)} as {c}" for c in columns])


def imputed_moments(df: DataFrame, columns: list[str], narrow: bool = True) -> DataFrame:
    """One row: per column the median, and mean and sample deviation after median imputation.

    The moments of the imputed column follow from those of the known values and the number of
    missing ones, so no further pass over the rows is needed. ``narrow`` as in ``exact_quantiles``.
    """
    known = summary(df, columns)
    # The summary is the same subquery as the one inside, which Spark runs once.
    brackets = _narrowed(df, columns, known, 0.5) if narrow else known
    ends = with_scalar(_quantile_ends(df, columns, brackets, 0.5), known, "_k")

    def moments(c: str) -> str:
        k, median = f"_k.{c}", _between(c)
        missing = f"(_k.rows - {k}.n)"
        gap = f"({k}.mean - {median})"
        squares = f"({k}.var * {k}.n + coalesce(try_divide({k}.n * {missing}, _k.rows) * {gap} * {gap}, 0.0D))"
        return f"""named_struct(
            'median', {median},
            'mean', try_divide({k}.n * {k}.mean + if({missing} = 0, 0.0D, {missing} * {median}), _k.rows),
            'std', case when {k}.min = {k}.max then 0.0D
                        when _k.rows > 1 then sqrt({squares} / (_k.rows - 1)) end) as {c}"""

    return ends.selectExpr(*map(moments, columns))


def settled(one_row: DataFrame) -> DataFrame:
    """Run a one-row frame now and return it as constants.

    For numbers that several steps use: they are computed once, and later plans hold plain literals.
    """
    row = one_row.first()

    def constant(value, kind) -> str:
        if isinstance(kind, T.StructType):
            parts = [value[i] if value is not None else None for i in range(len(kind.fields))]
            fields = zip(kind.fields, parts)
            return f"named_struct({', '.join(f'{f.name!r}, {constant(part, f.dataType)}' for f, part in fields)})"
        text = "null" if value is None else f"'{value!r}'"
        return f"cast({text} as {kind.simpleString()})"

    columns = [f"{constant(row[f.name], f.dataType)} as {f.name}" for f in one_row.schema.fields]
    return one_row.sparkSession.sql(f"select {', '.join(columns)}")


def medians_of(moments: DataFrame, columns: list[str]) -> DataFrame:
    """Only the medians of an ``imputed_moments`` row."""
    return moments.selectExpr(*[f"{c}.median as {c}" for c in columns])


def impute_median(df: DataFrame, columns: list[str], medians: DataFrame | None = None) -> DataFrame:
    """Replace NULLs by the column's exact median over the given frame."""
    medians = exact_quantiles(df, columns) if medians is None else medians
    return with_scalar(df, medians, "_m").withColumns(
        {c: F.expr(f"coalesce({c}, _m.{c})") for c in columns}
    ).drop("_m")
