"""Training-data operators over document, page and token tables.

One module per operator; ``queries`` holds the thin registered queries and their DuckDB SQL.
Nothing outside this subpackage imports it.
"""
