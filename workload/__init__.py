"""The engine's operators run over the star-schema tables, each with an independent SQL answer."""
