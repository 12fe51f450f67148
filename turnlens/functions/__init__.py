"""Column functions: text, values, keys, prompts and model replies."""
