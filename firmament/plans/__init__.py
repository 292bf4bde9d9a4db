"""The jobs: table in, table out."""
