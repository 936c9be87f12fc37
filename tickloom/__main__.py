from tickloom.cli import main

main()
