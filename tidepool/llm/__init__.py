"""Training-data operators: text in, decisions or encoded files out.

Each module holds one operator with its own interface; :mod:`queries` applies them
to the driver tables and :mod:`oracles` holds DuckDB SQL for those SQL can express.
"""
