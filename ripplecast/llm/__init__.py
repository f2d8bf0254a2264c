"""Training-data operators: filters, classifiers, duplicate removal, packing."""
