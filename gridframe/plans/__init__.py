"""What a query reads: metadata, chunk layout and chunk pruning."""
