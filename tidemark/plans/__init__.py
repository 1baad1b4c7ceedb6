from tidemark.plans import catalogue, scalars  # noqa: F401  (each registers its queries)
