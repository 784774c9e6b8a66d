"""Column functions: spellings, math, names, captions and array kernels."""
