"""Dating texts on Spark: wiki pages to period classes, features and classifiers.

Everything public is a plain function from DataFrame to DataFrame (or Column to
Column), so steps chain with ``df.transform``.
"""
