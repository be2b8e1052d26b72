"""The jobs: upload a file, execute it, remove it."""
