"""Sources: driver tables, landing files (binaryFile), virtual files, topics."""
