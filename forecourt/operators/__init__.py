"""Table operators: ``DataFrame`` in, ``DataFrame`` out (usable with ``df.transform``)."""
