"""Domain plans: lazy compositions of the blocks in ``moneyflow.operators`` over typed DataFrames."""
