"""Named queries over the shared tables, their SQL twins, and the training and evaluation jobs."""
