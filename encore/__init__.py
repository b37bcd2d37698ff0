"""encore: daily analytics for a network of karaoke booths, written as Spark DataFrame plans.

Layout
------
functions/  Column-level rules (parsing, address rules, scores); each returns a ``Column``.
operators/  Reusable relational steps: trailing windows, distributed ranking, top-n,
            size-checked dimension joins, set/merge steps, batched Python hooks.
sources/    Scans (table, day, day range, text log), sinks (day partition, snapshot,
            keyed fan-out, JDBC export) and the stand-in tables built from the driver data.
plans/      The daily jobs, each a plain ``DataFrame(s) -> DataFrame`` function.
streaming/  The client-log landing job over a file stream.
"""

__version__ = "0.1.0"
