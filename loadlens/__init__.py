"""loadlens: shipment-rate analytics as Spark jobs over tables of loads."""
