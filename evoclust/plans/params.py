"""Parameters shared by the registered queries and their SQL twins."""

SEED = 7  # seed of every draw
K = 10  # clusters (embeddings carry 10 labels)
P = 4  # chromosomes in the population queries
ITERS = 3  # unrolled Lloyd iterations
MUT_RATE = 0.1  # mutation rate of the mutation query
OFFSET = 1000000.0  # shift of the off-centre queries
