"""Column functions: text folding, ids, frames, vectors."""
