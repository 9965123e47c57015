from eventide.app import main

main()
