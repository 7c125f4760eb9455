"""Column functions: text, JSON repair, answer choices and prompts. Each takes and returns Columns, so it stays in the JVM."""
