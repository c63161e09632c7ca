"""Named queries and the SQL each is checked against."""

#: Modules that each hold QUERIES (name: function of session and folder) and SQL (name: statement).
CORE = tuple(f"lexlake.plans.{name}_queries" for name in ("snapshot", "dictionary", "corpus", "catalog", "search", "inventory", "layer", "language"))
