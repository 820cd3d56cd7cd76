"""marketflow: market event analytics as Spark DataFrame functions.

Layers, bottom up:

* ``functions``  column expressions (time buckets, exact numbers, labels)
* ``sources``    reading raw messages and seeds, writing tables
* ``operators``  DataFrame in, DataFrame out; no action inside
* ``plans``      facts, live views and monitoring reports composed of operators
* ``streaming``  the same semantics on Structured Streaming

Time is always explicit: whatever depends on "now" takes ``as_of``.
"""
