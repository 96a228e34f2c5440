from pyspark.sql import Column
from pyspark.sql import functions as F


def array_mean(values: Column) -> Column:
    """Mean of an array of numbers. NULL for an empty or NULL array and when an element is NULL."""
    total = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return F.try_divide(total, F.size(values))


def ordered_values(value: Column, *order: Column) -> Column:
    """Aggregate: array of the non-NULL values of a group, sorted by ``order`` and then by value."""
    named = [c.alias(f"o{i}") for i, c in enumerate(order)]
    entry = F.when(value.isNotNull(), F.struct(*named, value.alias("v")))
    return F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["v"])
