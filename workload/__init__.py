"""The given tables as energy and weather feeds, the registered queries over them, and their SQL twins."""
