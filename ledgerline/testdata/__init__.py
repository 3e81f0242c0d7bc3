"""Mapping of the generated test tables onto the transaction data model.

The generated tables are not bank transactions; ``events JOIN customer`` is
mapped column by column onto the wide RAW table so every operator can run on
them. :mod:`ledgerline.testdata.oracle` holds the same mapping in DuckDB SQL.
"""
