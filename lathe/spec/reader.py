"""Builds the columns of one dimension grammar.

A grammar is a short list of reading steps over one text column. ``Reader``
turns each step into native expressions; intermediate texts become staged
columns, so nothing is evaluated twice and every pattern is a literal.
"""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.rx import as_col, blank_to_null, grab, grab_all, grab_last, like, sub, sub_first

FIELDS = (
    "width",
    "depth",
    "height",
    "length",
    "diameter",
    "weight",
    "seat_width",
    "seat_depth",
    "seat_height",
    "arm_height",
    "arm_width",
    "shade",
)


def array_pick(arr: Column, pick: str) -> Column:
    return F.try_element_at(arr, F.lit(1 if pick == "first" else -1))


class Reader:
    def __init__(self, df: DataFrame, text: Column):
        self.df = df
        self._n = 0
        self.values: dict[str, Column] = {}
        self.t = self.stage(text)

    # -- staging -----------------------------------------------------------
    def stage(self, value: Column) -> Column:
        name = f"__s{self._n}"
        self._n += 1
        self.df = self.df.withColumn(name, value)
        return F.col(name)

    def settle(self) -> None:
        """Make the values found so far plain columns, before steps that test them."""
        names = {f: f"__s{self._n + i}" for i, f in enumerate(self.values)}
        self._n += len(names)
        self.df = self.df.withColumns({names[f]: v for f, v in self.values.items()})
        self.values = {f: F.col(n) for f, n in names.items()}

    # -- text steps --------------------------------------------------------
    def clean(self, *pairs) -> None:
        c = self.t
        for pattern, repl in pairs:
            c = sub(c, pattern, repl)
        self.t = self.stage(c)

    def rewrite(self, fn) -> None:
        self.t = self.stage(fn(self.t))

    def scope(self, pattern: str, group: int = 1, required: bool = False) -> None:
        """Read only inside the first match; without one, all of the text or nothing."""
        hit = grab(self.t, pattern, group)
        self.t = self.stage(hit if required else F.coalesce(hit, self.t))

    # -- value steps -------------------------------------------------------
    def get(self, field: str) -> Column:
        return self.values.get(field, F.lit(None).cast("string"))

    def put(self, field: str, value: Column, unless=(), when: Column | None = None, override: bool = False) -> None:
        for other in unless:
            value = F.when(self.get(other).isNull(), value)
        if when is not None:
            value = F.when(when, value)
        old = self.values.get(field)
        if old is not None:
            value = F.coalesce(value, old) if override else F.coalesce(old, value)
        self.values[field] = value

    def take(self, field: str, *patterns: str, group: int = 1, pick: str = "first", **how) -> None:
        """First pattern that matches gives the value; earlier steps keep priority."""
        find = grab if pick == "first" else grab_last
        self.put(field, F.coalesce(*[find(self.t, p, group) for p in patterns]), **how)

    def consume(self, field: str, *patterns: str, unless=(), group: int = 1) -> None:
        """Take, then remove what the winning pattern matched from the text."""
        self.settle()
        free = F.lit(True)
        for other in unless:
            free = free & self.get(other).isNull()
        text, value = self.t, F.lit(None).cast("string")
        for p in reversed(patterns):
            hit = grab(self.t, p, group)
            value = F.coalesce(hit, value)
            text = F.when(hit.isNotNull(), sub_first(self.t, p)).otherwise(text)
        self.put(field, F.when(free, value))
        self.settle()
        self.t = self.stage(F.when(free, text).otherwise(self.t) if unless else text)

    def shape(self, fields, pattern: str, unless=(), override: bool = False, pick: str = "first") -> None:
        """One pattern, several values: group i goes to ``fields[i]``."""
        if pick == "last":
            hit = grab_last(self.t, f"({pattern})")
            found = {f: grab(hit, pattern, i + 1) for i, f in enumerate(fields)}
        else:
            found = {f: grab(self.t, pattern, i + 1) for i, f in enumerate(fields)}
        free = F.lit(True)
        for other in unless:
            free = free & self.get(other).isNull()
        for f, v in found.items():
            self.put(f, F.when(free, v) if unless else v, override=override)

    def cascade(self, *shapes, pick: str = "first") -> Column:
        """Shapes tried in order, the first that matches gives all values. Returns "matched"."""
        hits = self.stage(
            F.coalesce(
                *[
                    F.when(F.size(grab_all(self.t, p, 0)) > 0, F.struct(F.lit(i).alias("shape"), array_pick(grab_all(self.t, p, 0), pick).alias("text")))
                    for i, (_, p) in enumerate(shapes)
                ]
            )
        )
        per_field: dict[str, list] = {}
        for i, (fields, p) in enumerate(shapes):
            for g, f in enumerate(fields, start=1):
                per_field.setdefault(f, []).append(F.when(hits["shape"] == i, grab(hits["text"], p, g)))
        for f, options in per_field.items():
            self.put(f, F.coalesce(*options))
        return hits.isNotNull()

    def tokens(self, pattern: str, labels: dict[str, str], number: str = r"(\d+(?:\.\d+)?)", pick: str = "first", **how) -> Column:
        """All matches of ``pattern`` in order; each field takes its first or last labelled one."""
        toks = self.stage(grab_all(self.t, pattern, 0))
        self.assign(toks, labels, number, pick, **how)
        return toks

    def assign(self, toks: Column, labels: dict[str, str], number: str = r"(\d+(?:\.\d+)?)", pick: str = "first", **how) -> None:
        for field, label in labels.items():
            mine = F.filter(toks, like(label))
            self.put(field, grab(array_pick(mine, pick), number), **how)

    def by_count(self, numbers: Column, layout: dict[int, tuple], when: Column | None = None, at_least: int | None = None) -> None:
        """Unlabelled numbers go to fields by how many there are."""
        nums = self.stage(numbers)
        n = F.size(nums)
        for count, fields in layout.items():
            hit = (n >= count) if count == at_least else (n == count)
            if when is not None:
                hit = hit & when
            for i, f in enumerate(fields):
                if f:
                    self.put(f, F.when(hit, blank_to_null(F.get(nums, F.lit(i)))))

    def each(self, fn) -> None:
        """Same clean-up on every value: one function over the array of values."""
        names = list(self.values)
        cleaned = self.stage(F.transform(F.array(*self.values.values()), lambda v: fn(v)))
        self.values = {f: F.get(cleaned, F.lit(i)) for i, f in enumerate(names)}

    # -- result ------------------------------------------------------------
    def finish(self, out: str) -> DataFrame:
        dims = F.struct(*[as_col(self.get(f)).cast("string").alias(f) for f in FIELDS])
        staged = [f"__s{i}" for i in range(self._n)]
        return self.df.withColumn(out, dims).drop(*staged)
